import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tagloom.llm import packing, token_store
from tagloom.llm.common import new_folder
from tagloom.llm.token_ids import Encoder, default_tokenizer

from .fixtures import empty_docs, odd_docs, odd_rows, odd_texts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def test_encoder_equals_whole_text_encoding(tokenizer):
    texts = odd_texts()
    ids, bounds = Encoder.of(default_tokenizer()).encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_store_round_trip(spark, tokenizer):
    path = new_folder(spark, "store")
    token_store.write_store(odd_docs(spark), path)
    got = token_store.read_digests(spark, path).orderBy("start").collect()
    whole = {r.start: r for r in token_store.read_ids(spark, path).collect()}
    want = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in odd_rows()]
    assert Counter((r.doc_id, tuple(whole[r.start].ids)) for r in got) == Counter((i, tuple(ids)) for i, ids in want)
    at = 0
    for r in got:
        ids = whole[r.start].ids
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x))
    assert len(token_store.store_root(spark, path)) == 64
    keys = [bytes(r.key) for r in spark.read.parquet(f"{path}/blocks").where("kind = 'chunk'").collect()]
    assert len(keys) == len(set(keys))


def test_store_notices_damage(spark):
    path = new_folder(spark, "store")
    token_store.write_store(odd_docs(spark), path)
    bad = spark.read.parquet(f"{path}/recipes").selectExpr("part", "doc_id", "start", "n_tokens", "slice(chunks, 1, 0) as chunks", "sha(chunks[0]) as root")
    other = new_folder(spark, "store")
    spark.read.parquet(f"{path}/manifest").write.parquet(f"{other}/manifest")
    spark.read.parquet(f"{path}/blocks").write.partitionBy("kind").parquet(f"{other}/blocks")
    bad.selectExpr("part", "doc_id", "start", "n_tokens", "chunks", "cast(root as binary) as root").write.parquet(f"{other}/recipes")
    with pytest.raises(ValueError, match="manifest"):
        token_store.read_digests(spark, other).collect()


def test_store_of_nothing(spark):
    path = new_folder(spark, "store")
    token_store.write_store(empty_docs(spark), path)
    assert token_store.read_digests(spark, path).count() == 0


def test_cuts_follow_content():
    r = np.random.default_rng(1)
    ids = r.integers(0, 40000, 20000).astype("<u4")
    other = np.concatenate([ids[:5000], ids[:7], ids[5000:]])
    both = np.concatenate([ids, other, ids[:1]])
    a, b, c = token_store.cuts(both, np.cumsum([0, len(ids), len(other), 1]))
    chunks = lambda x, ends: {x[s:e].tobytes() for s, e in zip([0, *ends[:-1]], ends, strict=True)}
    assert len(chunks(ids, a) & chunks(other, b)) >= len(a) - 4
    assert max(np.diff([0, *a])) <= token_store.MAX_IDS
    assert a == token_store.cuts(ids, np.array([0, len(ids)]))[0]
    assert c == [1]


def test_joined_crcs():
    r = np.random.default_rng(2)
    docs = [[r.integers(0, 60000, n).astype("<u4") for n in sizes] for sizes in ((1, 64, 700, 3), (5,), (2048, 2048, 64, 64, 9, 1))]
    crcs = np.array([zlib.crc32(p.tobytes()) for d in docs for p in d])
    sizes = np.array([len(p) for d in docs for p in d])
    got = token_store.joined_crcs(crcs, sizes, np.cumsum([0, *map(len, docs)]))
    assert got.tolist() == [zlib.crc32(np.concatenate(d).tobytes()) for d in docs]


def test_packing_against_brute_force(spark, tokenizer):
    got = packing.pack(odd_docs(spark), capacity=256, shard_pieces=30).collect()
    want = Counter()
    for r in odd_rows():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at : at + 256], "<u4")
            want[r[0], k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(empty_docs(spark)).count() == 0


def test_sum_of_squares_wastes_little():
    r = np.random.default_rng(3)
    lengths = np.sort(np.minimum(2048, r.lognormal(6, 1, 20000).astype(int) + 1))[::-1]
    bins, offsets = packing.sum_of_squares(lengths, 2048)
    assert bins.max() + 1 <= 1.01 * lengths.sum() / 2048 + 1
    fill = np.bincount(bins, lengths)
    assert fill.max() <= 2048


def test_sum_of_squares_rule_against_plain_form():
    r = np.random.default_rng(4)
    lengths, capacity = r.integers(1, 21, 400), 20
    bins, _ = packing.sum_of_squares(lengths, capacity)
    gaps: list[int] = []
    for size, at in zip(lengths.tolist(), bins.tolist(), strict=True):
        def score(gap):
            after = Counter(g for g in gaps if 0 < g < capacity)
            if gap < capacity:
                after[gap] -= 1
            if gap - size:
                after[gap - size] += 1
            return sum(v * v for v in after.values())
        allowed = {g for g in gaps if size <= g < capacity} | {capacity}
        best = min(map(score, allowed))
        gap = gaps[at] if at < len(gaps) else capacity
        assert score(gap) == best
        if at == len(gaps):
            gaps.append(capacity)
        gaps[at] -= size


def test_encoder_on_random_unicode(tokenizer):
    """Texts of characters of all planes, marks, digits, white space and special strings, against the tokenizer itself."""
    r = random.Random(17)
    planes = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x600), (0x900, 0xA00), (0x1100, 0x1200), (0x1E00, 0x2100), (0x2100, 0x2C00), (0x3000, 0x3200), (0x4E00, 0x4F00), (0xAC00, 0xAD00), (0xFB00, 0xFF70), (0x1D400, 0x1D500), (0x1F300, 0x1F700)]
    special = ["<|endoftext|>", "<|", "|>", "'s", "don't", "I'LL", "x's!", "...", "!?", "a.b", "3.14", "İ", "ẞ", "ﬁ", "Σς", "\u200d", "\ufeff", "\x85", "\u2028", "\xa0"]
    blanks = [" ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\u3000", "\x1f"]

    def word():
        if r.random() < 0.15:
            return r.choice(special)
        lo, hi = r.choice(planes if r.random() < 0.5 else planes[:2])
        return "".join(c for c in (chr(r.randrange(lo, hi)) for _ in range(r.randint(1, 9))) if not 0xD800 <= ord(c) < 0xE000)

    texts = ["".join(word() + r.choice(blanks if r.random() < 0.9 else [""]) for _ in range(r.randint(0, 25))) for _ in range(800)]
    ids, bounds = Encoder(default_tokenizer()).encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)

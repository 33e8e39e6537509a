import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import common, near_dup, substring_dedup
from tagloom.llm.common import may_contain, membership, rolled

from .fixtures import empty_docs, odd_docs, odd_rows, words


def family(seed=1, n=140):
    """Texts of which many share passages or are near copies of each other."""
    r = random.Random(seed)
    pool = [f"v{i}" for i in range(400)]
    prose = lambda k: [r.choice(pool) for _ in range(k)]
    passages, bases, out = [prose(60) for _ in range(4)], [prose(r.choice([30, 90, 200])) for _ in range(6)], []
    for _ in range(n):
        kind = r.random()
        if kind < 0.5:
            text = list(r.choice(bases))
            for _ in range(r.randint(0, max(1, len(text) // 25))):
                text[r.randrange(len(text))] = r.choice(pool)
            if r.random() < 0.3:
                text = text[: r.randint(len(text) // 2, len(text))]
        elif kind < 0.8:
            text = prose(r.randint(0, 80)) + r.choice(passages) + prose(r.randint(0, 80))
        elif kind < 0.9:
            text = r.choice(passages)[:5] + prose(r.randint(1, 60))
        else:
            text = prose(r.randint(0, 6))
        out.append((" " if r.random() < 0.9 else " \n").join(text))
    return out


def sets_of(text, width):
    ws = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = words(ws)
    if len(ws) >= width:
        return frozenset(tuple(ws[i : i + width]) for i in range(len(ws) - width + 1))
    return frozenset([tuple(ws)] if ws else [])


def brute_components(rows, width, percent):
    sets = [sets_of(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append(r[0])
    best = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return [(r[0], len(s), best[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


@pytest.mark.parametrize(("texts", "width", "percent"), [(None, 4, 85), ("family", 4, 85), ("family", 2, 60), ("family", 5, 80)])
def test_components_against_brute_force(spark, texts, width, percent):
    texts = family(width) if texts else None
    got = near_dup.near_components(odd_docs(spark, texts), width, percent)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()]
    assert Counter(got) == Counter(brute_components(odd_rows(texts), width, percent))


def test_components_with_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "HEAVY", 3)
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near_dup, "BLOCK", 5)
    texts = family(9, 120)
    got = near_dup.near_components(odd_docs(spark, texts), 4, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == Counter(brute_components(odd_rows(texts), 4, 85))


@pytest.mark.parametrize("hot", [10_000, 2])
def test_full_filters_are_replaced_by_joins(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "FILTER_FULL", -1.0)
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    texts = family(8, 70)
    got = near_dup.near_components(odd_docs(spark, texts), 4, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == Counter(brute_components(odd_rows(texts), 4, 85))
    found = substring_dedup.remove_repeats(odd_docs(spark, texts), 20).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == Counter(brute_removal(odd_rows(texts), 20))


def test_components_without_star_help(spark, monkeypatch):
    """The second search alone must find what the first leaves."""
    monkeypatch.setattr(near_dup._Join, "stars", lambda self: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", 4)
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    texts = family(4, 80)
    got = near_dup.near_components(odd_docs(spark, texts), 4, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == Counter(brute_components(odd_rows(texts), 4, 85))


def test_long_chain_of_labels(spark):
    edges = spark.range(300).selectExpr("(id * 37) % 301 as a", "((id + 1) * 37) % 301 as b")
    labels = near_dup.components(edges).collect()
    assert {r.label for r in labels} == {0}
    assert len(labels) == 301


@pytest.mark.parametrize("rows", [10_000, 3])
def test_components_of_random_edges(spark, monkeypatch, rows):
    """rows: edges of a node that is told to all tasks."""
    monkeypatch.setattr(near_dup, "HOT_ROWS", rows)
    monkeypatch.setattr(common, "HOT_ROWS", rows)
    r = random.Random(rows)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(90)] + [(200, i) for i in range(200, 240)] + [(300 + i, 299 + i) for i in range(60)]
    root = list(range(400))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {x.node: x.label for x in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for e in edges for i in e if e[0] != e[1]} | {i: find(i) for i in got}
    assert near_dup.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_hashed_words_are_the_words(spark):
    texts = odd_rows()
    texts = [r[1] for r in texts] + ["x" * 5000, "y" * 64 + "z" * 64, "z" * 64 + "y" * 64, "A", "a", "\x0b\x0c a\x1fb ", "é\u3000é É"]
    for lower in (False, True):
        for a, b in ((0, len(texts)), (3, 20)):
            array = pa.array(texts, pa.string()).slice(a, b - a)
            codes, offsets, vocabulary = common.split_words(array, lower)
            found = common.hashed_words(array, lower)
            assert found.offsets.tolist() == offsets.tolist()
            pairs = set(zip(codes.tolist(), found.hashes.tolist(), strict=True))
            assert len(pairs) == len(vocabulary) == len({h for _, h in pairs})


def test_drop_near_copies(spark):
    texts = family(3)
    left = near_dup.drop_near_copies(odd_docs(spark, texts))
    assert left.columns == odd_docs(spark).columns
    rows = odd_rows(texts)
    parts = brute_components(rows, 4, 85)
    empty = {(r[0], r[1]) for r, p in zip(rows, parts, strict=True) if not p[1]}
    got = Counter((r.doc_id, r.text) for r in left.collect())
    assert {k for k in got if k in empty} == empty
    linked = [(r, p) for r, p in zip(rows, parts, strict=True) if p[1]]
    kept = {k for k in got if k not in empty}
    by_component = defaultdict(set)
    for r, p in linked:
        by_component[p[2]].add((r[0], r[1]))
    for members in by_component.values():
        assert len(members & kept) == 1


def test_nothing(spark):
    assert near_dup.near_components(empty_docs(spark)).count() == 0
    assert substring_dedup.remove_repeats(empty_docs(spark)).count() == 0


def brute_removal(rows, window):
    lists = [words(r[1]) for r in rows]
    first = {}
    order = lambda i: (i is None, i or 0)
    for r, ws in zip(rows, lists, strict=True):
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            if key not in first or order(r[0]) < order(first[key]):
                first[key] = r[0]
    out = []
    for r, ws in zip(rows, lists, strict=True):
        gone = set()
        for i in range(len(ws) - window + 1):
            if order(first[tuple(ws[i : i + window])]) < order(r[0]):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((r[0], len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("texts", "window"), [(None, 50), ("family", 50), ("family", 7), ("family", 1)])
def test_removal_against_brute_force(spark, texts, window):
    texts = family(window) if texts else None
    got = substring_dedup.remove_repeats(odd_docs(spark, texts), window).collect()
    have = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got)
    assert have == Counter(brute_removal(odd_rows(texts), window))
    for r in got:
        assert sum(x.stop - x.start for x in r.removed) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.removed[:-1], r.removed[1:], strict=True))
        if r.n_removed:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_rolled_and_least_against_plain_loops():
    r = np.random.default_rng(0)
    values = r.integers(0, 5, 300).astype(np.uint64)
    for width in (1, 2, 3, 7, 25, 26, 50):
        hashes = rolled(values, width, substring_dedup._BASES[0])
        same = defaultdict(set)
        for i, h in enumerate(hashes.tolist()):
            same[tuple(values[i : i + width].tolist())].add(h)
        assert len(hashes) == 300 - width + 1
        assert all(len(v) == 1 for v in same.values())
        assert len({h for v in same.values() for h in v}) == len(same)
        low = substring_dedup.least(values, width)
        assert low.tolist() == [min(values[i : i + width].tolist()) for i in range(300 - width + 1)]


def test_membership_never_misses(spark):
    keys = [hash((i, "x")) for i in range(5000)] + [-1, 0, 2**63 - 1, -(2**63)]
    bitmap = np.frombuffer(membership(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 20), np.uint8)
    assert may_contain(bitmap, np.array(keys, np.int64)).all()
    others = np.random.default_rng(1).integers(-(2**62), 2**62, 5000)
    assert may_contain(bitmap, others).mean() < 0.05


def test_short_texts_have_one_gram():
    values, bounds = near_dup.shingle_sets(pa.array(["a b", "A B", "a", None, "", "a b c d", "x a b c d"]))
    assert np.diff(bounds).tolist() == [1, 1, 1, 0, 0, 1, 2]
    assert values[0] == values[1] != values[2]

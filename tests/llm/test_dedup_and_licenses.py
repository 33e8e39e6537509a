import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.llm import exact_dedup, license_scan

from .fixtures import SEP, empty_docs, odd_docs, odd_rows


@pytest.mark.parametrize("piece", [exact_dedup.PIECE, 1, 4])
def test_exact_groups_against_brute_force(spark, monkeypatch, piece):
    """piece: rows of one beginning that stay together; all texts that share one are dealt to several places at 1."""
    monkeypatch.setattr(exact_dedup, "PIECE", piece)
    got = exact_dedup.exact_groups(odd_docs(spark)).collect()
    groups = defaultdict(list)
    for row in odd_rows():
        groups[SEP.sub(" ", row[1] or "")].append(row[0])
    want = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, left = (min(known) if known else None), True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            stays = left and i == keep
            left = left and not stays
            want.append((i, keep, len(ids), stays, hashlib.sha256(norm.encode()).hexdigest()))
    key = lambda r: (r[4], r[0] is None, r[0] or 0, not r[3])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_a_group_of_copies_is_dealt_to_many_places(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same  text', concat('text ', id)) as text")
    monkeypatch.setattr(exact_dedup, "PIECE", 100)
    got = exact_dedup.exact_groups(docs)
    assert got.where("kept").count() == 2001
    assert got.where("group_size = 1000 and keep_id = 0").count() == 1000
    assert exact_dedup._runs(docs, "doc_id", "text", False).where("many > 1 and first").count() > 5  # pieces of the group
    left = exact_dedup.drop_exact_copies(docs.withColumn("z", F.lit(1)))
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in got.where("kept").collect()}


def test_beginnings_of_equal_texts_are_equal(spark, monkeypatch):
    """White space of any length, before and within the beginning, and texts that differ after it alone."""
    long = "x" * exact_dedup.HEAD
    texts = [" " * 5000 + "a b", "  a\t\nb", "a b ", "a  b", f"{long} y", f"{long}\n\ny", f"{long} z", f"{long}y", "日本\u3000語" * 30, "日本\u3000語" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for piece in (exact_dedup.PIECE, 1):
        monkeypatch.setattr(exact_dedup, "PIECE", piece)
        got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs).collect()}
        assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 8}


@pytest.mark.parametrize("piece", [exact_dedup.PIECE, 1])
def test_drop_exact_copies_keeps_columns(spark, monkeypatch, piece):
    monkeypatch.setattr(exact_dedup, "PIECE", piece)
    docs = odd_docs(spark).toDF(*["_sha" if c == "key" else "salt" if c == "lang" else "norm" if c == "low" else "run" if c == "norm" else c for c in odd_docs(spark).columns])
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns and left.schema == docs.schema
    assert left.count() == len({SEP.sub(" ", r[1] or "") for r in odd_rows()})
    kept = {r.doc_id for r in exact_dedup.exact_groups(odd_docs(spark)).where("kept").collect()}
    assert {r.doc_id for r in left.collect()} == kept
    assert exact_dedup.drop_exact_copies(empty_docs(spark)).count() == 0


def test_empty_tables(spark):
    assert exact_dedup.exact_groups(empty_docs(spark)).count() == 0
    assert license_scan.scan(empty_docs(spark)).count() == 0


def blocks_of(low):
    """First line, number of lines, and a function of a template's size to the block's words, or none if it has too many."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lines = [word.findall(line) for line in low.split("\n")]
    for i in range(len(lines)):
        for k in range(1, license_scan.LINES + 1):
            part = lines[i : i + k]
            if len(part) < k or (k > 1 and not all(part)):
                break
            ws = [w for line in part for w in line]
            yield i, k, lambda size, ws=ws, k=k: set(ws) if k == 1 or len(ws) <= license_scan.WIDE * size else set()


def brute_scan(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    ws = word.findall(low)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    more, best = set(labels), 0.0
    for _, _, found in blocks_of(low):
        for label, texts in license_scan.TEMPLATES.items():
            for t in texts:
                share = len({*t.split()} & found(len({*t.split()}))) / len({*t.split()})
                if share >= license_scan.THRESHOLD:
                    more.add(label)
                    best = max(best, share)
    first, last = (min(places), max(places)) if places else (None, None)
    return len(ws), len(places), first, last, ",".join(sorted(labels)), ",".join(sorted(more)), 1.0 if places else best


def license_texts():
    r = random.Random(3)
    pool = sorted({w for ts in license_scan.TEMPLATES.values() for t in ts for w in t.split()})
    out = []
    for _ in range(60):
        t = r.choice([t for ts in license_scan.TEMPLATES.values() for t in ts]).split()
        out.append("\n".join(" ".join(w.title() for w in t if r.random() > 0.08) + " " + " ".join(r.choices(pool, k=3)) for _ in range(2)))
    return out


@pytest.mark.parametrize("texts", [None, "licenses"])
def test_scan_against_brute_force(spark, texts):
    texts = license_texts() if texts else None
    got = license_scan.scan(odd_docs(spark, texts)).collect()
    want = [(r[0], *brute_scan(r[1])) for r in odd_rows(texts)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_template_order_and_filters_lose_no_pair(spark):
    texts = license_texts()
    found = license_scan.template_matches(odd_docs(spark, texts), threshold=0.6)
    want = set()
    for i, text, *_ in odd_rows(texts):
        for b, lines, have in blocks_of((text or "").lower()):
            for label, ts in license_scan.TEMPLATES.items():
                for k, t in enumerate(ts):
                    s = {*t.split()}
                    if len(s & have(len(s))) >= 0.6 * len(s) - 1e-9:
                        want.add((i, b, lines, label, k))
    assert {(r.id, r.block, r.lines, r.label, r.template) for r in found.collect()} == want


def test_wrapped_notices(spark):
    notice = license_scan.TEMPLATES["bsd"][0].split()
    wrapped = "\n".join(" ".join(notice[i : i + 7]) for i in range(0, len(notice), 7))
    apart = wrapped.replace("\n", "\n\n")
    scattered = "\n".join(" ".join([*notice[i : i + 7], *["other"] * 40]) for i in range(0, len(notice), 7))
    docs = spark.createDataFrame(list(enumerate([wrapped, apart, scattered, "x y\n# " + wrapped.replace("\n", "\n# ")])), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in license_scan.scan(docs).collect()} == {0: "bsd", 1: "", 2: "", 3: "bsd"}

import os
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import corpus_pipeline
from tagloom.llm import toxicity
from tagloom.llm.common import BATCH_BYTES, keep

from .fixtures import SCHEMA, SEP, empty_docs, odd_rows
from .test_duplicates import brute_components, family
from .test_models import mixing_rows, toxic_rows

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = toxic_rows(300)
    extra = family(6, 90)
    rows += [(1000 + i, t, "en", "s", 1, "k", "l", "i", "n", 0, 0) for i, t in enumerate(extra)]
    rows += [(2000 + i, r[1], *r[2:]) for i, r in enumerate(odd_rows()[:15])]
    rows.append((3000, "  " + rows[0][1].replace(" ", "\n"), *rows[0][2:]))
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_each_stage_on_its_own_input(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES][:3] == ["toxicity", "exact dedup", "n-gram Jaccard join"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, outputs = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if i < 4 else None
        out = keep(stage(spark, docs, folder))
        outputs.append((before, docs, out))
        if i < 4:
            assert out.columns == columns
        docs = out
    before, docs, out = outputs[0]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    clean = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 0").collect()}
    assert {r.doc_id for r in out.collect()} == clean and len(clean) < len(before)
    before, docs, out = outputs[1]
    groups = defaultdict(list)
    for i, t in before.items():
        groups[SEP.sub(" ", t or "")].append(i)
    assert sorted(r.doc_id for r in out.collect()) == sorted(min(v) for v in groups.values())
    before, docs, out = outputs[2]
    parts = brute_components(list(before.items()), corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, n, c in parts if not n or i == c)
    before, docs, out = outputs[3]
    copies = Counter(r.doc_id for r in out.collect())
    assert copies.keys() == before.keys() and max(copies.values()) > 1
    before, docs, out = outputs[4]
    firsts = Counter(r.doc_id for r in out.where("piece = 0").collect())
    assert firsts == copies
    fill = out.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in fill) <= 2048


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 0


def test_empty_tables(spark, tmp_path):
    empty_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_lists_all_queries():
    import __spark_entry__ as e

    names = e.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(e.oracle_sql()) <= set(names)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the shared tables")
@pytest.mark.parametrize("name", ["op2_exact_dedup", "op6_license_scan", "op7_ngram_jaccard_join", "op8_substring_dedup"])
def test_queries_against_sql(spark, name):
    import duckdb

    import __spark_entry__ as e

    path = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{path}/documents.parquet'")
    got, want = e.queries()[name](spark, path).toPandas(), db.sql(e.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda f: sorted(map(repr, f[sorted(f.columns)].astype(object).where(f[sorted(f.columns)].notna(), None).map(lambda v: float(v) if isinstance(v, int | float) else v).itertuples(index=False, name=None)))
    assert plain(got) == plain(want)


def test_mix_reaches_its_shares(spark, tmp_path):
    rows, labels = mixing_rows(400, 5)
    docs = spark.createDataFrame([r for r, (_, _, t) in zip(rows, labels, strict=True) if not t and (labels[r[0]][1] or r[0] % 4 == 0)], SCHEMA)
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    tokens = Counter()
    for r in corpus_pipeline.mix(spark, docs, str(tmp_path)).collect():
        tokens["high" if labels[r.doc_id][1] else "low"] += len(r.text.split())
    before = Counter()
    for r in docs.collect():
        before["high" if labels[r.doc_id][1] else "low"] += len(r.text.split())
    assert before["low"] / before.total() < 0.2
    assert tokens["low"] / tokens.total() == pytest.approx(corpus_pipeline.MIX["low"], abs=0.03)


@pytest.mark.parametrize("name", ["toxicity", "n-gram Jaccard join", "mixing to target weights", "best-fit packing"])
def test_python_functions_of_a_stage_get_bounded_batches(spark, folder, name):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], ["n", "size"])

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame([], SCHEMA), folder)
    long = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat('word ', 2000) as text")
    found = long.mapInArrow(sizes, "n long, size long").collect()
    spark.conf.unset(setting)
    assert sum(r.n for r in found) == 2000 and max(r.size for r in found) < BATCH_BYTES + 100_000

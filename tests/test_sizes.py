"""What a task holds must not grow with its input."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.functions import passes
from tagloom.functions import spans as sp
from tagloom.plans import catalog_queries, source_queries  # noqa: F401
from tagloom.sources import conll, readers


def largest_batch(rows, *columns):
    """Bytes of the largest batch that a pass gets of these columns."""

    def size(*arrays: pa.Array) -> pa.Array:
        return pa.array([sum(a.nbytes for a in arrays)] * len(arrays[0]), pa.int64())

    def run(a: pa.Array) -> pa.Array:
        return size(a)

    return rows.select(F.arrow_udf(run, "bigint")(*columns).alias("n")).agg(F.max("n")).first()[0]


def test_batches_are_bounded(spark, tmp_path):
    rows = spark.range(0, 400, 1, 1).select(F.array_repeat(F.lit("words"), 10_000).alias("tokens"))
    for use in (lambda: sp.joined_spans(F.col("tokens"), F.lit(" ")), lambda: catalog_queries.table(spark, str(tmp_path), "t")):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        spark.range(3).write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
        use()
        assert largest_batch(rows, "tokens") < passes.BATCH_BYTES + 200_000
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    passes.bounded(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"


# --- lines ------------------------------------------------------------------------------------------------------------


LINES = "-DOCSTART-\tO\n\na\tB-X\nb\tI-X\n\nc\tO\n\n\n-DOCSTART-\tO\n\nd\tO\ne\tB-Y\nf\tO\n"


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_a_file_is_read_in_parts(spark, tmp_path):
    """As one text it would be one row, however large."""
    (tmp_path / "a.txt").write_text(LINES * 50)
    (tmp_path / "b.txt").write_text(LINES.replace("\n", "\r\n"))
    key = "spark.sql.files.maxPartitionBytes"
    whole = {r.line_no: r.line for r in conll.lines(spark, str(tmp_path / "a.txt")).collect()}
    assert whole == dict(enumerate((LINES * 50).split("\n")[:-1]))
    want = conll.read(spark, str(tmp_path), "conll2003_two_column").drop("source").collect()
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "257")
        rows = conll.lines(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 10
        each = [r.line for r in rows.where(F.col("source").endswith("a.txt")).orderBy("line_no").collect()]
        assert each == list(whole.values())
        got = conll.read(spark, str(tmp_path), "conll2003_two_column").drop("source").collect()
    finally:
        spark.conf.set(key, old)
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 3 * 50 + 3


def test_lines_go_on_from_batch_to_batch(spark):
    """Batches of any size give the same tokens, for all kinds of dialects."""
    text = {"conll2003_two_column": LINES, "conllu_uner": "# newdoc id = 1\n# text = A b\n1\tA\tB-X\t-\tx\n2\tb\tO\t-\tx\n# no comment\tc\tO\n\n# newdoc id = 2\n1\tC\tO\t-\tx\n"}
    for dialect, one in text.items():
        rows = [(s, i, line) for s in ("p", "q") for i, line in enumerate(((one + "\n") * 3).split("\n"))]
        frame = spark.createDataFrame(rows, "source string, line_no long, line string")
        wanted, size = None, "spark.sql.execution.arrow.maxRecordsPerBatch"
        for many in (1, 2, 3, 7, 1000):
            spark.conf.set(size, many)
            got = sorted(map(repr, conll.parse(frame, dialect).collect())), sorted(map(repr, conll.of_lines(frame, dialect).collect()))
            wanted = wanted or got
            assert got == wanted and len(got[0]) == (36 if dialect == "conll2003_two_column" else 24)
        spark.conf.unset(size)


def test_lines_cut_from_rows_are_not_shuffled(spark):
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("needs the shared tables")
    for name in ("conll_dialects", "conll_row_parse", "preprocessor_e_ner", "columnar_segments"):
        shown = plan(catalog_queries.QUERIES[name](spark, d))
        assert "Window" not in shown and shown.count("hashpartitioning") == (name == "columnar_segments")


def test_documents_are_read_in_parts(spark, tmp_path):
    """Files of many documents are not one row: each reader gives the same from small parts of its files, in any batches."""
    words = ["a}", "{b", '"c"', "]}"]
    item = {"tokens": words, "ner": [[0, 1, ["L"]], [3, 3, "M"]]}
    passage = '<passage><offset>0</offset><text>x&lt;y z</text><annotation><infon key="type">T</infon><location offset="4" length="1"/><text>z</text></annotation></passage>'
    ids = [*range(40), 3, 7]
    bioc = "".join(f"<document><id>{i}</id>{passage}</document>\n" for i in ids)
    texts = {
        "arabic_cross_dialectal_json": json.dumps([item] * 40),
        "bioc_xml": f"<?xml version='1.0'?><!DOCTYPE collection SYSTEM 'x.dtd'><collection><source>documents</source>{bioc}</collection>\n",
        "plain_spans": '#tid:1\none two\nmore\n[[0, 3, "N", "one"]]\n\nthree\n[]\n' * 20,
    }
    size, batch = "spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    for name, content in texts.items():
        (tmp_path / name).write_text(content)
        rows = readers.read(name, spark, str(tmp_path / name))
        want = sorted(rows.select("text", "ner", "document_position").collect())
        assert len(want) == 40
        try:
            spark.conf.set(size, "300")
            spark.conf.set(batch, "3")
            rows = readers.read(name, spark, str(tmp_path / name))
            assert "wholetext" not in plan(rows).lower() and conll.parts(spark, str(tmp_path / name)).rdd.getNumPartitions() > 3
            assert sorted(rows.select("text", "ner", "document_position").collect()) == want
            assert rows.select("source", "document").distinct().count() == 40
        finally:
            spark.conf.set(size, old)
            spark.conf.unset(batch)
    (tmp_path / "bad.json").write_text('[{"tokens": ["a"], "ner": []}, {"tokens": ["b"')
    with pytest.raises(Exception, match="no list of objects"):
        readers.read("arabic_cross_dialectal_json", spark, str(tmp_path / "bad.json")).collect()


def test_sentences_of_words_are_cut_once(spark, tmp_path):
    """Not each sentence looks at all entities, and each entity at all sentences."""
    n = 300
    line = {"words": ["w"] * 2 * n, "sentences": [[2 * i, 2 * i + 2] for i in range(n)], "ner": [[2 * i, 2 * i + 1, "X"] for i in range(n)]}
    (tmp_path / "x.jsonl").write_text(json.dumps(line) + "\n" + json.dumps(line | {"ner": []}))
    rows = readers.read("scirex_jsonl", spark, str(tmp_path / "x.jsonl"))
    assert "exists(" not in plan(rows)
    got = rows.orderBy("document", "document_position").collect()
    assert len(got) == 2 * n and {(r.text, len(r.ner)) for r in got} == {("w w", 1), ("w w", 0)}
    assert [r.space_after for r in got[:n]] == [" "] * (n - 1) + [""]
    (tmp_path / "y.jsonl").write_text(json.dumps(line | {"sentences": [[0, 1], [2, 2 * n]], "ner": [[1, 2, "X"]]}))
    with pytest.raises(Exception, match="lies in no sentence"):
        readers.read("scirex_jsonl", spark, str(tmp_path / "y.jsonl")).collect()

"""Exact deduplication by a distributed content sort.

Sampled splitters deal the texts to ranges by how they begin, an external sort within each range puts equal texts next to
each other, and each is compared in full with its neighbour: a run of equal texts is a group, whose first row has the smallest
id. Many texts that begin alike are dealt to several neighbouring places by their ids, as many as their number asks for; only
the first rows of the runs found there are then compared once more, by their whole texts. Only built-in expressions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SEPARATORS, keep, most_frequent, table, text_or_empty

#: Characters, white space apart, of the beginning that splitters are drawn from.
HEAD = 48
#: Rows of one beginning that stay together, about, and how many beginnings with more rows every task knows at most.
PIECE, KNOWN = 2_000, 100_000
#: The beginning of a text up to its HEAD-th other character, however long the white space between.
_BEGINNING = r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]){0,%d}" % HEAD


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SEPARATORS, " ")


def _runs(docs: DataFrame, id_col: str, text_col: str, whole: bool) -> DataFrame:
    """One row per input row: id, head, salt, many (salts of the head), run, first (of its run), norm; whole: and row, all columns.

    Texts cross the network once, as they are: what splitters are sampled from is their beginnings alone, and whole texts are
    normalised after that.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        normalised(F.regexp_extract(text, _BEGINNING, 0)).alias("head"),
        *([F.struct(*docs.columns).alias("row")] if whole else []),
    )
    heads = keep(rows.groupBy("head").agg(F.count("*").alias("n")).where(F.col("n") > PIECE), "heads")
    often = most_frequent(heads, "n", KNOWN).select("head", F.ceil(F.col("n") / PIECE).cast("int").alias("many"))
    rows = rows.join(F.broadcast(often), "head", "left")  # KNOWN rows at most
    rows = rows.withColumn("many", F.coalesce("many", F.lit(1))).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("many")).cast("int"))
    ranged = rows.repartitionByRange("head", "salt").withColumn("norm", normalised(F.col("text"))).drop("text")
    near = W.partitionBy("head", "salt").orderBy("norm", F.col("id").asc_nulls_last())
    before = F.lag("norm").over(near)
    marked = ranged.withColumn("first", before.isNull() | (before != F.col("norm")))
    return marked.withColumn("run", F.sum(F.col("first").cast("int")).over(near.rowsBetween(W.unboundedPreceding, W.currentRow)))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after each run of blanks and controls from tab to carriage return became one blank; null
    counts as empty. Of equal texts the row with the smallest id is kept. Rows that repeat an id and a text count each in
    group_size, and one of them is kept. Null ids come last, and one such row is kept where a group has no other id; rows of
    one text without ids are sorted by one task. Columns other than the two named are not read. An empty table gives an
    empty result.
    """
    runs = _runs(docs, id_col, text_col, False)
    several = F.col("many") > 1
    narrow = runs.select(
        "id", "head", "salt", "many", "run", "first", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), F.when(several & F.col("first"), F.col("norm")).alias("norm")
    )
    run = W.partitionBy("head", "salt", "run")
    found = narrow.withColumns({"keep_id": F.min("id").over(run), "group_size": F.count("*").over(run)})
    found = keep(found, "runs")
    # The runs of a text in several places become one group; as many rows meet as its beginning has places.
    same = W.partitionBy("norm")
    groups = found.where(several & F.col("first")).select(
        "head", "salt", "run", F.min("keep_id").over(same).alias("keep_id"), F.sum("group_size").over(same).alias("group_size")
    )
    alone = found.where("many = 1").drop("norm")
    dealt = found.where(several).drop("norm", "keep_id", "group_size").join(groups, ["head", "salt", "run"])
    return alone.unionByName(dealt).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & F.col("first")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns, whatever their names.

    Null and empty texts are equal and one of them stays. Of rows equal in text and id, or without ids, one stays; which of
    them is open where other columns differ. An empty table stays empty. Rows cross the network once, and the first ones of
    texts that begin like many others a second time.
    """
    first = _runs(docs, id_col, text_col, True).where("first")
    first = keep(first.select("id", "many", "row", F.when(F.col("many") > 1, F.col("norm")).alias("norm")), "firsts")
    nth = F.row_number().over(W.partitionBy("norm").orderBy(F.col("id").asc_nulls_last()))
    dealt = first.where("many > 1").withColumn("nth", nth).where("nth = 1")
    return first.where("many = 1").select("row.*").unionAll(dealt.select("row.*"))


SQL = r"""
with n as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
)
select doc_id, min(doc_id) over (partition by norm) as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept,
       sha256(norm) as text_sha256
from n
"""


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))

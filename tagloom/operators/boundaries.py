"""Tables of sentence boundaries made ahead: one row for each row of a split, found by its running number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import segment_id
from ..schema import SENTENCE_OFFSETS

_OFFSETS = SENTENCE_OFFSETS["sentence_offsets"].dataType.simpleString()
#: Documents of one range of numbers, which one task counts through.
RANGE = 100_000


def numbered(rows: DataFrame, keys: tuple[str, ...] = ("document_index",), position: tuple[str, ...] = ("document_position",), name: str = "sequence_index") -> DataFrame:
    """Adds the running number of each row of a split, from 0, by document and place in it.

    Documents are counted range by range: no task sees more than RANGE documents and the sums of all ranges. keys: the last
    one is the number of the document, those before it tell apart splits.
    """
    *above, document = keys
    ranged = rows.withColumn("_range", F.floor(F.col(document) / RANGE))
    before = F.sum("_many").over((W.partitionBy(*above) if above else W.partitionBy(F.lit(0))).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    sums = ranged.groupBy(*above, "_range").agg(F.count("*").alias("_many"))
    first = sums.select(*above, "_range", F.coalesce(before, F.lit(0)).alias("_first"))
    nth = F.row_number().over(W.partitionBy(*above, "_range").orderBy(document, *position)) - 1
    out = ranged.withColumn("_nth", nth).join(F.broadcast(first), [*above, "_range"])  # one row for each range of documents
    return out.withColumn(name, (F.col("_first") + F.col("_nth")).cast("long")).drop("_range", "_nth", "_first")


def write_boundaries(rows: DataFrame, path: str, file: str, offsets: str = "sentence_offsets") -> None:
    """sequence_id, sentence_offsets of each row, in files whose order is that of the rows; the id is made of a file's name and
    the row's number."""
    each = numbered(rows).repartitionByRange("sequence_index").sortWithinPartitions("sequence_index")
    table = each.select(segment_id(F.lit(file), F.col("sequence_index")).alias("sequence_id"), F.col(offsets).alias("sentence_offsets"))
    table.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """sequence_index, sequence_id, sentence_offsets. A row's number is its place in the table, files being in the order of their
    names; ids don't tell rows apart in tables of other makers."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    found = spark.read.parquet(path).select("sequence_id", F.col("sentence_offsets").cast(_OFFSETS).alias("sentence_offsets"), place.alias("_at"))
    before = F.sum("_many").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1))  # one row for each file
    files = found.groupBy(F.col("_at.file").alias("_file")).agg(F.count("*").alias("_many")).select("_file", F.coalesce(before, F.lit(0)).alias("_first"))
    placed = found.join(F.broadcast(files), F.col("_at.file") == F.col("_file"))
    return placed.select((F.col("_first") + F.col("_at.row")).alias("sequence_index"), "sequence_id", "sentence_offsets")


def with_boundaries(rows: DataFrame, boundaries: DataFrame, offsets: str = "sentence_offsets") -> DataFrame:
    """rows with the boundaries that stand at their number. A row that has none stops the job."""
    told = boundaries.select("sequence_index", F.col("sentence_offsets").alias(offsets))
    found = F.coalesce(offsets, F.raise_error(F.lit("a row has no sentence boundaries")))
    return numbered(rows).join(told, "sequence_index", "left").withColumn(offsets, found).drop("sequence_index")

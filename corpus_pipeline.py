"""The corpus pipeline: toxicity, exact deduplication, near-duplicates, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. No stage drops a document that the one before kept for another
reason than its own: the mix repeats documents to reach its targets and leaves none out (its least rate is 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import exact_dedup, mixing, near_dup, packing, toxicity
from tagloom.llm.common import bound_batches, keep

#: Shares of the mix. Its size follows from them: no document is left out, so it grows until each domain has its share.
MIX = {"low": 0.3, "low_toxic": 0.0, "high": 0.7, "high_toxic": 0.0}
#: Words of a shingle, and the similarity in percent, of near-duplicates.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches a half go."""
    bound_batches(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the one with the smallest id stays."""
    bound_batches(spark)
    return near_dup.drop_near_copies(docs, SHINGLE, PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated by their fitted rates."""
    bound_batches(spark)
    return mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), MIX, growth=None, floor=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of 2048 tokens."""
    bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: Its models can't be expressed in SQL; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = keep(docs, name.replace(" ", "-"))
    return docs

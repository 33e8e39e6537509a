"""Row-wise operators over streams. The corpus operators keep no state between batches; those that group need whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.stats import word_stats


def stream_word_stats(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Word counts of rows as files arrive in a folder; append mode, no shuffle, no state."""
    return word_stats(spark.readStream.schema(schema).parquet(path), keys)

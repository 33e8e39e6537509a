"""How Python functions get their rows: in Arrow batches of a bounded size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes of a batch. What a pass makes of its batch (offsets, codes, what it returns) is some ten times that.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(spark: SparkSession | None = None) -> None:
    """From here on, what this session runs hands Python functions BATCH_BYTES of rows at once, or what the session set, if less.
    Spark gathers up to 64 MB otherwise, for each core and each pass that doesn't follow right on another, and a pass makes
    several times as much of it. The setting stays, as queries run later; no result depends on it."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    said = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH))
    if not 0 < said <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def arrow(run: Callable, kind: str) -> Callable[..., Column]:
    """A pass over Arrow columns as a function of columns, in bounded batches."""
    bounded()
    return F.arrow_udf(run, kind)

"""Projections and filters over sequence tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import continuous
from ..functions.text import IGNORED_LANGUAGES
from ..schema import DEFAULT_TAGSET


def project(rows: DataFrame, tagset: str = DEFAULT_TAGSET, more: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a sample, the tagset under its default name. space_after stays, as merging needs it."""
    names = ["document_index", "document_position", "sequence_id", "text", "space_after"]
    return rows.select(*[c for c in (*names, *more) if c in rows.columns], F.col(tagset).alias(DEFAULT_TAGSET))


def rename_tagset(rows: DataFrame, tagset: str) -> DataFrame:
    """A tagset and its tags under the default names."""
    return rows.withColumnsRenamed({tagset: DEFAULT_TAGSET, f"{tagset}_iob": f"{DEFAULT_TAGSET}_iob"})


def drop_tagsets(rows: DataFrame, tagsets: tuple[str, ...]) -> DataFrame:
    return rows.drop(*tagsets, *[f"{t}_iob" for t in tagsets])


def with_entities(rows: DataFrame, tagset: str = DEFAULT_TAGSET) -> DataFrame:
    """Rows with an annotation; null counts as none."""
    return rows.where(F.coalesce(F.size(tagset), F.lit(0)) > 0)


def drop_discontinuous(rows: DataFrame, tagset: str = DEFAULT_TAGSET) -> DataFrame:
    """Only annotations of one span, which then is a struct rather than an array."""
    return rows.withColumn(tagset, continuous(F.col(tagset)))


def datasets_where_all(splits: DataFrame, keeps: Column) -> DataFrame:
    """The splits of datasets of which every split passes."""
    passing = splits.groupBy("dataset").agg(F.min(F.coalesce(keeps, F.lit(False))).alias("all")).where("all").select("dataset")
    return splits.join(passing, "dataset", "left_semi")


def known_languages(rows: DataFrame, language: str = "language") -> DataFrame:
    return rows.where(~F.col(language).isin(*IGNORED_LANGUAGES))


def without_processed(rows: DataFrame, done: DataFrame, key: str = "dataset") -> DataFrame:
    """Rows of datasets that a former result doesn't have."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def only_requested(rows: DataFrame, requested: DataFrame, key: str = "dataset") -> DataFrame:
    return rows.join(requested.select(key).distinct(), key, "left_semi")

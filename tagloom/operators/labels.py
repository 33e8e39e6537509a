"""Label inventories, and strict mapping of labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import spans as sp
from ..functions import tags as tag
from ..schema import ANNOTATIONS, DEFAULT_TAGSET

LabelMaps = dict[str, dict[tuple[str, ...], dict[str, dict[str, str]]]]


def label_inventory(rows: DataFrame, tagset: str = DEFAULT_TAGSET, by: tuple[str, ...] = ("subset",)) -> DataFrame:
    """The sorted distinct labels of each group. Labels are made distinct before they are gathered."""
    labels = rows.select(*by, F.explode(F.transform(tagset, lambda a: a["label"])).alias("label")).distinct()
    return labels.groupBy(*by).agg(F.sort_array(F.collect_list("label")).alias("labels"))


def tag_inventory(rows: DataFrame, tags: str = f"{DEFAULT_TAGSET}_iob", by: tuple[str, ...] = ("subset",)) -> DataFrame:
    """The sorted distinct tags of each group; null for a group without any."""
    found = rows.select(*by, F.explode_outer(tags).alias("tag")).distinct()
    kept = F.sort_array(F.collect_list("tag"))
    return found.groupBy(*by).agg(F.when(F.size(kept) > 0, kept).alias("bio_labels"))


def expand_label_map(compact: Mapping[str, list[Mapping]]) -> LabelMaps:
    """dataset -> subset -> tagset -> table, from entries of (subsets, tagset, label_map)."""
    out: LabelMaps = {}
    for dataset, entries in compact.items():
        for entry in entries:
            unknown = set(entry) - {"subsets", "tagset", "label_map"}
            if unknown:
                raise ValueError(f"unknown keys in the label map of {dataset}: {sorted(unknown)}")
            for subset in entry["subsets"]:
                out.setdefault(dataset, {}).setdefault(tuple(subset), {})[entry["tagset"]] = dict(entry["label_map"])
    return out


def label_table(spark: SparkSession, maps: LabelMaps) -> DataFrame:
    """The same as rows: dataset, subset (joined by /), tagset, src, dst."""
    rows = [(d, "/".join(s), t, a, b) for d, subsets in maps.items() for s, sets in subsets.items() for t, table in sets.items() for a, b in table.items()]
    return spark.createDataFrame(rows, "dataset string, subset string, tagset string, src string, dst string")


def mapped(annotations: Column, table: dict[str, str]) -> Column:
    """Annotations with labels by the table; a label that isn't in it stops the job."""
    return F.transform(annotations, lambda a: sp.annotation(tag.strict(a["label"], table), a["spans"])).cast(ANNOTATIONS.simpleString())


def mapped_tags(tags: Column, table: dict[str, str]) -> Column:
    """Whole tags by the table of their labels."""
    return tag.each_strict(tags, tag.tag_table(table))


def map_labels(rows: DataFrame, tables: dict[str, dict[str, str]], tokenized: bool = False) -> DataFrame:
    """All tagsets of a subset by their tables, and their tags where there are any."""
    new = {t: mapped(F.col(t), table) for t, table in tables.items()}
    if tokenized:
        new |= {f"{t}_iob": mapped_tags(F.col(f"{t}_iob"), table) for t, table in tables.items()}
    return rows.withColumns(new)

"""Splits of columnar sources under their usual names, and dealt by language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(
    spark: SparkSession, paths: str | list[str], kind: str = "parquet", select: list[str] | None = None, rename: dict[str, str] | None = None, **options
) -> DataFrame:
    """Local files of a columnar source: parquet, json (a document a line) or csv with a header, whose empty cells are empty
    strings, as tokens like null and NA are what they say. rename: old to new names; select: columns that stay, by their new names."""
    readers = {"parquet": {}, "json": {}, "csv": {"header": True, "multiLine": True, "escape": '"'}}
    if kind not in readers:
        raise ValueError(f"unknown kind of files: {kind}")
    rows = spark.read.format(kind).options(**readers[kind] | options).load(paths).withColumnsRenamed(rename or {})
    rows = rows.fillna("") if kind == "csv" else rows
    return rows.select(*select) if select else rows


@dataclass(frozen=True)
class Naming:
    """How a source names its splits and tells languages.

    train, validation, test: its names of these splits, if it has them. pattern: of a split's whole name, with the groups
    split and, if they are there, language and year; all splits that a source has then count. subset: the name of a
    subset; only_subset: whether there is no other, so that it needs no name. subset_pattern: of the subset's name, with the group
    language. language: of all rows; language_column: of each row.
    """

    train: str | None = "train"
    validation: str | None = None
    test: str | None = None
    pattern: str | None = None
    subset: str = ""
    only_subset: bool = True
    subset_pattern: str | None = None
    language: str | None = None
    language_column: str | None = None


class Part(NamedTuple):
    """subset: (name, kind) of each level, where a kind is language, year or None."""

    split: str
    language: str
    subset: tuple[tuple[str, str | None], ...]
    rows: DataFrame


def _groups(pattern: str, name: str, what: str) -> dict[str, str | None]:
    found = re.fullmatch(pattern, name)
    if found is None:
        raise ValueError(f"{what} {name!r} doesn't fit {pattern!r}")
    return found.groupdict()


def by_language(rows: DataFrame, column: str | None, language: str | None) -> Iterator[tuple[str, tuple, DataFrame]]:
    """Language, levels and rows of each part: rows of one language alone, or of no column for it, are one part without a level.

    Only the names of languages reach the driver. Parts come in the order of their names, and keep the order of their rows.
    """
    if column is None:
        if language is None:
            raise ValueError("a language or a column of languages is needed")
        yield language, (), rows
        return
    names = sorted(str(r[0]) for r in rows.select(column).distinct().collect())
    if len(names) == 1:
        yield names[0], (), rows
        return
    for name in names:
        same = F.coalesce(F.col(column).cast("string"), F.lit("None")) == name
        yield name, ((name, "language"),), rows.where(same)


def normalised(splits: dict[str, DataFrame], naming: Naming) -> Iterator[Part]:
    """The parts of a subset's splits. A name that doesn't fit its pattern, and a part without a language, are errors."""
    language, top = naming.language, ()
    if naming.subset_pattern is not None:
        language = _groups(naming.subset_pattern, naming.subset, "the subset")["language"]
        top = ((naming.subset, "language"),)
    elif not naming.only_subset:
        top = ((naming.subset, None),)
    usual = {old: new for new in ("train", "validation", "test") if (old := getattr(naming, new)) is not None}
    if naming.pattern is None:
        wanted = [(old, new, language, top) for old, new in usual.items()]
    else:
        wanted = []
        for old in splits:
            found = _groups(naming.pattern, old, "the split")
            unknown = found.keys() - {"split", "language", "year"}
            if unknown:
                raise ValueError(f"unknown groups in {naming.pattern!r}: {sorted(unknown)}")
            levels = tuple((found[kind], kind) for kind in ("language", "year") if found.get(kind))
            wanted.append((old, usual.get(found["split"], found["split"]), found.get("language") or language, top + levels))
    for old, new, own, levels in wanted:
        if own is None and (naming.language_column is None or naming.pattern is not None):
            raise ValueError(f"no language is known for the split {old!r}")
        for name, more, rows in by_language(splits[old], naming.language_column, own):
            yield Part(new, name, levels + more, rows)

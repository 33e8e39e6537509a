"""All splits of all datasets in one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_TAGSET
from .documents import merge_documents
from .selecting import drop_tagsets, rename_tagset


def merge_splits(splits: list[tuple[dict, DataFrame]], tagset_of: dict[str, str] | None = None, merge: bool = False) -> DataFrame:
    """Rows of all splits with dataset, subset (joined by /), split and language. tagset_of None drops all labels; a dataset with
    several tagsets needs a choice. Columns that a split lacks are null. With merge, a row is a whole document, without tokens; documents of a
    split are numbered from 0 without gaps, so their number is the chunk's."""
    out = []
    for entry, rows in splits:
        tagsets = list(entry["tagsets"])
        if tagset_of is None:
            rows = drop_tagsets(rows, tuple(tagsets))
        elif len(tagsets) > 1:
            if entry["dataset"] not in tagset_of:
                raise KeyError(f"{entry['dataset']} has several tagsets ({', '.join(tagsets)}); name one")
            chosen = tagset_of[entry["dataset"]]
            rows = rename_tagset(drop_tagsets(rows, tuple(t for t in tagsets if t != chosen)), chosen)
        elif tagsets and tagsets[0] != DEFAULT_TAGSET:
            rows = rename_tagset(rows, tagsets[0])
        if merge:
            rows = merge_documents(rows).withColumnRenamed("document_index", "chunk_index")
        else:
            for name in ("tokens", *([f"{DEFAULT_TAGSET}_iob"] if tagset_of is not None else [])):
                if name not in rows.columns:
                    rows = rows.withColumn(name, F.lit(None).cast("array<string>"))
        out.append(
            rows.withColumns(
                {
                    "dataset": F.lit(entry["dataset"]),
                    "subset": F.lit("/".join(entry["subset"])),
                    "split": F.lit(entry["split"]),
                    "language": F.lit(entry["language"]),
                }
            )
        )
    if not out:
        raise ValueError("no splits to merge")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)

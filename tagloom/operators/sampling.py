"""Quota samples: so many rows of each dataset, dealt over its subsets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import DEFAULT_TAGSET
from .documents import budget_segments, merge_documents
from .selecting import with_entities


def shares(limit: int, parts: int) -> list[int]:
    """The limit over the parts; the last takes what is left over."""
    each, rest = divmod(limit, parts)
    return [each] * (parts - 1) + [each + rest]


def quota_sample(rows: DataFrame, group: str, part: str, limit: int, order: tuple[str, ...]) -> DataFrame:
    """The first rows of each part of each group, by an explicit order. Parts are numbered by name; a part with too few rows
    isn't made up for. Parts are counted from a small table of their names; rows are numbered within parts only, and Spark
    keeps no more of a part than its rank asks for."""
    parts = rows.select(group, part).distinct()
    window = W.partitionBy(group)
    parts = parts.withColumn("_k", F.count("*").over(window)).withColumn("_i", F.row_number().over(window.orderBy(part)))
    quota = F.floor(F.lit(limit) / F.col("_k")) + F.when(F.col("_i") == F.col("_k"), F.lit(limit) % F.col("_k")).otherwise(0)
    numbered = rows.withColumn("_n", F.row_number().over(W.partitionBy(group, part).orderBy(*order))).where(F.col("_n") <= limit)
    return numbered.join(parts.withColumn("_q", quota), [group, part]).where("_n <= _q").drop("_k", "_i", "_n", "_q")


def monolingual_sample(
    splits: list[tuple[dict, DataFrame]],
    language: str,
    per_dataset: int,
    split: str = "train",
    tagset_of: dict[str, str] | None = None,
    merge: bool = False,
    keep_without_entities: bool = True,
    dataset_column: bool = True,
    target_tokens: int | None = None,
    token_count: Column | None = None,
) -> DataFrame:
    """Rows of one language and split from each dataset, up to `per_dataset`.

    splits: of each split its catalog entry (dataset, subset, split, language, tagsets) and its rows. A dataset with several
    tagsets needs a choice in tagset_of, and a language without data is an error. With merge, documents come whole, or in
    segments of about target_tokens by token_count (words by default).
    """
    found = []
    for entry, rows in splits:
        if entry["language"] != language or entry["split"] != split:
            continue
        tagset = DEFAULT_TAGSET
        if len(entry["tagsets"]) > 1:
            if not tagset_of or entry["dataset"] not in tagset_of:
                raise KeyError(f"{entry['dataset']} has several tagsets ({', '.join(entry['tagsets'])}); name one")
            tagset = tagset_of[entry["dataset"]]
        elif entry["tagsets"]:
            tagset = entry["tagsets"][0]
        names = ["document_index", "document_position", "sequence_id", "text", "space_after"]
        part = rows.select(*names, F.col(tagset).alias(DEFAULT_TAGSET))
        if merge:
            if target_tokens is not None:
                count = token_count if token_count is not None else F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
                part = budget_segments(part, count, target_tokens)
            part = merge_documents(part, by_segment=target_tokens is not None)
            part = part.withColumn("document_position", F.col("segment_id") if target_tokens is not None else F.lit(0).cast("long"))
            part = part.drop("segment_id")
        if not keep_without_entities:
            part = with_entities(part)
        found.append(part.withColumns({"dataset": F.lit(entry["dataset"]), "_subset": F.lit("/".join(entry["subset"]))}))
    if not found:
        raise ValueError(f"no data in language {language!r}")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    sample = quota_sample(rows, "dataset", "_subset", per_dataset, ("document_index", "document_position")).drop("_subset")
    return sample if dataset_column else sample.drop("dataset")

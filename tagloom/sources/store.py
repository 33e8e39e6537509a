"""Corpora on disk: one folder per dataset, one Parquet table per split, and a metadata file beside them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import sequence_id, uuid_bytes
from ..operators.labels import label_inventory, tag_inventory
from ..operators.stats import split_counts
from ..schema import sequence_schema, signed

METADATA_FILE = "corpus_metadata.json"


@dataclass
class Split:
    path: str
    document_count: int = 0
    sequence_count: int = 0
    creation_metadata: dict = field(default_factory=dict)


@dataclass
class Subset:
    """A node of a dataset's tree of subsets, with its own splits."""

    name: str
    language: str = ""
    pre_tokenized: bool = False
    tagsets: list[str] = field(default_factory=list)
    labels: dict[str, list[str]] = field(default_factory=dict)
    bio_labels: dict[str, list[str]] | None = None
    splits: dict[str, Split] = field(default_factory=dict)
    subsets: list[Subset] = field(default_factory=list)
    hierarchy: list[str] = field(default_factory=list)

    def __contains__(self, split: str) -> bool:
        return split in self.splits


@dataclass
class Dataset:
    name: str
    languages: list[str] = field(default_factory=list)
    main_splits: list[str] = field(default_factory=list)
    subsets: list[Subset] = field(default_factory=list)
    folder: str = ""

    def __iter__(self) -> Iterator[Subset]:
        """All subsets in pre-order, names sorted on each level."""
        todo = sorted(self.subsets, key=lambda s: s.name, reverse=True)
        while todo:
            node = todo.pop()
            yield node
            todo += sorted(node.subsets, key=lambda s: s.name, reverse=True)

    def dump(self, folder: str | Path) -> None:
        data = asdict(self)
        data.pop("folder")
        Path(folder, METADATA_FILE).write_text(json.dumps(data, indent=1, ensure_ascii=False, sort_keys=True))

    @classmethod
    def load(cls, folder: str | Path) -> Dataset:
        data = json.loads(Path(folder, METADATA_FILE).read_text())
        return cls(data["name"], data["languages"], data["main_splits"], [_subset(s, []) for s in data["subsets"]], str(folder))


def _subset(data: dict, above: list[str]) -> Subset:
    path = [*above, data["name"]] if data["name"] else above
    splits = {k: Split(**v) for k, v in data["splits"].items()}
    rest = {k: v for k, v in data.items() if k not in ("splits", "subsets", "hierarchy")}
    return Subset(**rest, splits=splits, subsets=[_subset(s, path) for s in data["subsets"]], hierarchy=path)


def dataset_names(folder: str | Path) -> list[str]:
    """Datasets in a folder, by name."""
    return sorted(p.name for p in Path(folder).iterdir() if (p / METADATA_FILE).is_file()) if Path(folder).is_dir() else []


def datasets(folder: str | Path) -> list[Dataset]:
    return [Dataset.load(Path(folder, name)) for name in dataset_names(folder)]


def split_path(dataset: Dataset, subset: Subset, split: str) -> str:
    return str(Path(dataset.folder, subset.splits[split].path))


def scan_split(spark: SparkSession, dataset: Dataset, subset: Subset, split: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of a split, lazily, with an explicit schema; columns are pruned in the scan."""
    rows = signed(spark.read.schema(sequence_schema(subset.tagsets, subset.pre_tokenized)).parquet(split_path(dataset, subset, split)))
    return rows.select(*columns) if columns else rows


def all_splits(spark: SparkSession, folder: str | Path) -> list[tuple[dict, DataFrame]]:
    """Each split's catalog entry and its rows."""
    return [(entry, scan_split(spark, d, s, entry["split"])) for d, s, entry in _entries(folder)]


def _entries(folder: str | Path) -> Iterator[tuple[Dataset, Subset, dict]]:
    for d in datasets(folder):
        for s in d:
            for name, split in s.splits.items():
                yield d, s, {
                    "dataset": d.name,
                    "subset": s.hierarchy,
                    "split": name,
                    "language": s.language,
                    "tagsets": s.tagsets,
                    "pre_tokenized": s.pre_tokenized,
                    "path": split_path(d, s, name),
                    "document_count": split.document_count,
                    "sequence_count": split.sequence_count,
                }


def catalog(spark: SparkSession, folder: str | Path) -> DataFrame:
    """One row per split of all datasets of a folder."""
    schema = (
        "dataset string, subset array<string>, split string, language string, tagsets array<string>, pre_tokenized boolean, "
        "path string, document_count long, sequence_count long"
    )
    return spark.createDataFrame([e for _, _, e in _entries(folder)], schema)


def with_ids(rows: DataFrame, dataset: str, subset: str, split: str, source: str = "source", document: str = "document") -> DataFrame:
    """Numbers documents from 0 by their source and place there, and gives each row its id. rows: document_position too.

    Documents are numbered within their source, side by side; only one row per source, its number of documents, meets in one
    task to give each source its first number.
    """
    from pyspark.sql import Window as W

    keys = rows.select(source, document).distinct()
    inside = keys.withColumn("_n", F.row_number().over(W.partitionBy(source).orderBy(document)).cast("long") - 1)
    before = F.sum("_many").over(W.orderBy(source).rowsBetween(W.unboundedPreceding, -1))
    first = keys.groupBy(source).agg(F.count("*").alias("_many")).select(source, F.coalesce(before, F.lit(0)).alias("_first"))
    numbered = inside.join(first, source).select(source, document, (F.col("_first") + F.col("_n")).alias("document_index"))
    rows = rows.join(numbered, [source, document])
    id_ = sequence_id(F.lit(dataset), F.lit(subset), F.lit(split), F.col("document_index"), F.col("document_position"))
    return rows.withColumn("sequence_id", id_)


def imported(rows: DataFrame) -> DataFrame:
    """Rows of a corpus that was exported, whose ids are text, with ids of 16 bytes and the types of the schema."""
    return signed(rows).withColumn("sequence_id", uuid_bytes(F.col("sequence_id")))


def write_split(rows: DataFrame, folder: str | Path, relative: str, tagsets: list[str], tokenized: bool) -> Split:
    """Write a split with zstd, in the schema's order of columns, and count it."""
    schema = sequence_schema(tagsets, tokenized)
    out = rows.select(*[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name, metadata=f.metadata) for f in schema.fields])
    path = str(Path(folder, relative))
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)
    written = rows.sparkSession.read.schema(schema).parquet(path).withColumn("_all", F.lit(1))
    counts = split_counts(written, ("_all",)).first()
    return Split(relative, *((counts["document_count"], counts["sequence_count"]) if counts else (0, 0)))


def inventories(rows: DataFrame, tagsets: list[str], tokenized: bool) -> tuple[dict[str, list[str]], dict[str, list[str]] | None]:
    """Labels and tags of a subset's rows by tagset; tags are None where there are none."""
    rows = rows.withColumn("_all", F.lit(1))
    first = lambda df, c: (df.first() or {c: []})[c] or []
    labels = {t: list(first(label_inventory(rows, t, ("_all",)), "labels")) for t in tagsets}
    if not tokenized:
        return labels, None
    tags = {t: list(first(tag_inventory(rows, f"{t}_iob", ("_all",)), "bio_labels")) for t in tagsets}
    return labels, (tags if any(tags.values()) else None)

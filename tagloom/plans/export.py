"""Export of a corpus: Parquet per configuration with text ids and mapped labels, and a card."""

from __future__ import annotations

import json
import shutil
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.ids import uuid_text
from ..functions.text import IGNORED_LANGUAGES
from ..operators.labels import LabelMaps, map_labels
from ..sources.store import datasets, scan_split

TEMPLATE = "---\n{{ card_data }}\n---\n\n# {{ pretty_name }}\n"
BOUNDS = ("n<1K", "1K<n<10K", "10K<n<100K", "100K<n<1M", "1M<n<10M", "10M<n<100M", "100M<n<1B", "1B<n<10B", "10B<n<100B", "100B<n<1T", "n>1T")


def config_name(dataset: str, hierarchy: list[str]) -> str:
    return "--".join([dataset, *hierarchy])


def size_category(n: int) -> str:
    """The range of a number of rows; an exact bound belongs to the range below it."""
    return BOUNDS[sum(n > 10**k for k in range(3, 13))]


def export(
    spark: SparkSession,
    source: str | Path,
    target: str | Path,
    keep: Any = None,
    label_maps: LabelMaps | None = None,
    template: str = TEMPLATE,
    pretty_name: str | None = None,
    extra_files: dict[str, list[str]] | None = None,
) -> dict:
    """Write each subset as a configuration; the card's data come back.

    keep: a function of a split's catalog entry; a dataset stays only if all its splits do. Labels go by the maps of the
    dataset and subset, strictly, and so do the labels listed in the card.
    """
    target = Path(target)
    configs, meta, languages, total = [], {}, set(), 0
    for dataset in datasets(source):
        entries = [(s, name, split) for s in dataset for name, split in s.splits.items()]
        facts = [{"dataset": dataset.name, "subset": s.hierarchy, "split": n, "language": s.language, **x.creation_metadata} for s, n, x in entries]
        if keep is not None and not all(map(keep, facts)):
            continue
        for subset in dataset:
            if not subset.splits:
                continue
            name = config_name(dataset.name, subset.hierarchy)
            tables = (label_maps or {}).get(dataset.name, {}).get(tuple(subset.hierarchy), {})
            if label_maps is not None and set(subset.tagsets) - set(tables):
                raise KeyError(f"no label map for {name}: {sorted(set(subset.tagsets) - set(tables))}")
            files = []
            for split, facts_ in subset.splits.items():
                rows = scan_split(spark, dataset, subset, split).withColumn("sequence_id", uuid_text(F.col("sequence_id")))
                if tables:
                    rows = map_labels(rows, tables, subset.pre_tokenized)
                path = f"{name}/{split}"
                rows.write.mode("overwrite").option("compression", "zstd").parquet(str(target / path))
                files.append({"split": split, "path": [f"{path}/*.parquet"]})
                total += facts_.sequence_count
            for extra in (extra_files or {}).get(dataset.name, []):
                shutil.copyfile(extra, target / name / Path(extra).name)
            if tables:
                subset.labels = {t: sorted({tables[t][y] for y in subset.labels.get(t, [])}) for t in subset.tagsets}
            configs.append({"config_name": name, "data_files": files})
        meta[dataset.name] = {"languages": dataset.languages, "labels": {config_name(dataset.name, s.hierarchy): s.labels for s in dataset}}
        languages.update(code.split("-")[0] for code in dataset.languages)
    card = {
        "pretty_name": pretty_name or target.name,
        "language": sorted(languages - {*IGNORED_LANGUAGES}),
        "multilinguality": "multilingual",
        "size_categories": size_category(total),
        "task_categories": ["token-classification"],
        "task_ids": ["named-entity-recognition"],
        "corpus_metadata": meta,
        "configs": configs,
    }
    target.mkdir(parents=True, exist_ok=True)
    text = template.replace("{{ card_data }}", json.dumps(card, indent=1, ensure_ascii=False)).replace("{{ pretty_name }}", card["pretty_name"])
    (target / "README.md").write_text(text)
    return card

"""Command line: list, sample, merge, count-words, cite, export, build."""

from __future__ import annotations

import argparse
import importlib
import json
import re
from collections.abc import Callable
from pathlib import Path


def _table(text: str) -> dict:
    """JSON in place, or a file of it."""
    return json.loads(text if text.lstrip().startswith("{") else Path(text).read_text())


def _function(text: str) -> Callable:
    """module:function"""
    module, _, name = text.partition(":")
    return getattr(importlib.import_module(module), name)


def _tokenizers(text: str) -> dict[str, Callable]:
    return {language: _function(name) for language, name in _table(text).items()}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tagloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    add = lambda name, text: sub.add_parser(name, help=text)
    c = add("list", "names of the datasets in a folder")
    c.add_argument("folder")
    c = add("sample", "rows of one language from each dataset")
    for name in ("folder", "language", "output"):
        c.add_argument(name)
    c.add_argument("-n", "--samples", type=int, default=100)
    c.add_argument("-s", "--split", default="train")
    c.add_argument("-t", "--tagsets", type=_table)
    c.add_argument("-m", "--merge-documents", action="store_true")
    c.add_argument("--target-tokens", type=int)
    c.add_argument("--tokenizer", type=_function, help="module:function that gives the tokens of a text, to count them by")
    c.add_argument("--without-entities", action="store_true", help="keep rows without entities too")
    c.add_argument("--drop-discontinuous", action="store_true")
    c = add("merge", "all splits in one table")
    for name in ("folder", "output"):
        c.add_argument(name)
    c.add_argument("-t", "--tagsets", type=_table)
    c.add_argument("-m", "--merge-documents", action="store_true")
    c = add("count-words", "counts of tokens, numbers, punctuation and words")
    for name in ("folder", "output"):
        c.add_argument(name)
    c.add_argument("-d", "--datasets", nargs="*", help="names or profiles")
    c.add_argument("-a", "--append", action="store_true", help="keep what the output has, and count only datasets it doesn't have")
    c.add_argument("-w", "--workers", type=int, help="tasks side by side")
    c.add_argument("--tokenizers", type=_tokenizers, help="JSON of language to module:function, for languages not written with blanks")
    c = add("cite", "BibTeX entries of datasets")
    c.add_argument("bibliography")
    c.add_argument("keys", nargs="?", help="JSON of dataset to keys; by default a dataset's key is its name")
    c.add_argument("--own", required=True)
    c.add_argument("--always", help="key of an entry that goes with the collection's own")
    c.add_argument("-d", "--datasets", nargs="*")
    c = add("export", "configurations with text ids and mapped labels, and a card")
    for name in ("folder", "output"):
        c.add_argument(name)
    c.add_argument("-l", "--label-map", type=_table)
    c.add_argument("-t", "--template")
    c.add_argument("--pretty-name")
    c.add_argument("-d", "--datasets", nargs="*", help="names or profiles")
    c.add_argument("--extra-files", type=_table, help="JSON of dataset to files that go with each of its configurations")
    c = add("build", "a dataset from source files by a plan in JSON")
    for name in ("plan", "folder"):
        c.add_argument(name)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "list":
        from .sources.store import dataset_names

        print("\n".join(dataset_names(a.folder)))
        return 0
    if a.command == "cite":
        from .plans.metadata import references

        text = Path(a.bibliography).read_text()
        entries = {m[1]: m[0].strip() for m in re.finditer(r"@\w+\{([^,]+),.*?\n\}", text, re.S)}
        keys = _table(a.keys) if a.keys else {k: [k] for k in entries}
        print("\n\n".join(references(keys, entries, a.own, a.datasets, a.always)))
        return 0

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from .operators import merging, sampling, selecting, stats
    from .sources import store

    builder = SparkSession.builder.appName("tagloom")
    if getattr(a, "workers", None):
        builder = builder.config("spark.default.parallelism", a.workers).config("spark.sql.shuffle.partitions", a.workers)
    spark = builder.getOrCreate()
    write = lambda df: df.write.mode("overwrite").option("compression", "zstd").parquet(a.output)
    if a.command == "sample":
        count = stats.number_of_tokens(F.col("text"), a.tokenizer) if a.tokenizer else None
        rows = sampling.monolingual_sample(
            store.all_splits(spark, a.folder), a.language, a.samples, a.split, a.tagsets, a.merge_documents, a.without_entities, True, a.target_tokens, count
        )
        write(selecting.drop_discontinuous(rows) if a.drop_discontinuous else rows)
    elif a.command == "merge":
        write(merging.merge_splits(store.all_splits(spark, a.folder), a.tagsets, a.merge_documents))
    elif a.command == "count-words":
        names = _resolved(a.folder, a.datasets)
        there = read_counts(spark, a.output) if a.append else None
        done = set() if there is None else {r[0] for r in there.select("dataset_name").distinct().collect()}  # names of datasets
        left = sorted(set(names) - done)
        if left or there is None:
            fresh = word_counts(spark, a.folder, left, a.tokenizers)
            fresh.write.mode("append" if a.append else "overwrite").option("compression", "zstd").parquet(a.output)
    elif a.command == "export":
        from .operators.labels import expand_label_map
        from .plans.export import TEMPLATE, export

        maps = expand_label_map(a.label_map) if a.label_map else None
        names = _resolved(a.folder, a.datasets)
        template = Path(a.template).read_text() if a.template else TEMPLATE
        export(spark, a.folder, a.output, lambda split: split["dataset"] in names, maps, template, a.pretty_name, a.extra_files)
    elif a.command == "build":
        from .plans.steps import Plan, State, Step

        plan = _table(a.plan)
        Plan([Step(s.pop("step"), s) for s in plan["steps"]], plan.get("loader"), plan.get("completed", ())).run(spark, State(Path(a.folder)))
    return 0


def _resolved(folder: str, names: list[str] | None) -> list[str]:
    """The datasets of a folder that are asked for, by name or profile; of a profile those that are there."""
    from .plans.metadata import PROFILES, resolve
    from .sources.store import dataset_names

    there = set(dataset_names(folder))
    here = {k: tuple(there.intersection(v)) for k, v in PROFILES.items()}
    return sorted(resolve(names or None, there, here))


def read_counts(spark, path: str):
    """Former counts, or None where there are none yet."""
    from pyspark.errors import AnalysisException

    from .operators.stats import WORD_STATS

    try:
        return spark.read.schema(WORD_STATS).parquet(path)
    except AnalysisException:
        return None


def word_counts(spark, folder: str, names: list[str] | None = None, tokenizers: dict[str, Callable] | None = None):
    """Counts of each row of the datasets; of tokens where a split has them, or by its language's tokenizer, else of words."""
    from functools import reduce

    from pyspark.sql import functions as F

    from .functions.text import IGNORED_LANGUAGES
    from .operators.stats import tokenized, word_stats
    from .sources.store import all_splits

    out = []
    for entry, rows in all_splits(spark, folder):
        if entry["language"] in IGNORED_LANGUAGES or (names is not None and entry["dataset"] not in names):
            continue
        facts = {
            "dataset_name": F.lit(entry["dataset"]),
            "subset_hierarchy": F.array(*map(F.lit, entry["subset"])).cast("array<string>"),
            "split_name": F.lit(entry["split"]),
            "language": F.lit(entry["language"]),
        }
        keys = [*facts, "sequence_id", "document_index", "document_position"]
        rows, own = rows.withColumns(facts), entry["language"] in (tokenizers or {})
        if own:
            rows = tokenized(rows.select(*keys, "text"), tokenizers)
        out.append(word_stats(rows, keys, F.col("tokens") if own or entry["pre_tokenized"] else None))
    if not out:
        raise ValueError("no split to count")
    return reduce(lambda a, b: a.unionByName(b), out)


if __name__ == "__main__":
    raise SystemExit(main())

"""Plans of steps that turn source files into a corpus, and the rules they must keep."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import groupby
from pathlib import Path
from typing import Any

from ..registry import Registry


class PlanError(ValueError):
    """A plan breaks a rule."""


# Kinds of steps; what each needs, one of these before it or nothing (None); and those that may come again.
NEEDS: dict[str, tuple[str, ...] | None] = {
    "download": None,
    "google_docs": None,
    "data_pipe": None,
    "git": None,
    "extract": ("download", "google_docs", "git", "huggingface"),
    "splits": ("download", "google_docs", "extract", "git", "huggingface"),
    "read_splits": ("download", "google_docs", "extract", "git", "huggingface"),
    "convert": ("splits", "read_splits", "git", "huggingface"),
    "columns": ("huggingface",),
    "metadata": ("data_pipe", "convert", "columns"),
}
REPEATABLE = frozenset({"download", "git", "google_docs", "splits", "read_splits", "extract", "data_pipe"})
#: Steps that need a network and aren't run here; their files are expected to be at hand.
REMOTE = frozenset({"download", "google_docs", "git", "huggingface"})


@dataclass
class Step:
    kind: str
    options: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class State:
    """What a stage hands to the next: a folder of files, the files of each split, the rows of each split, the kinds of steps
    that were done. A stage makes a new one."""

    folder: Path
    files: dict[str, Any] = field(default_factory=dict)
    rows: dict[str, Any] = field(default_factory=dict)
    done: frozenset[str] = frozenset()

    def having(self, **more: dict[str, Any]) -> State:
        """With further splits by their files or rows; the name of a split is taken once."""
        taken = sorted(k for what, new in more.items() for k in new.keys() & getattr(self, what).keys())
        if taken:
            raise PlanError(f"splits are there already: {taken}")
        return replace(self, **{what: getattr(self, what) | new for what, new in more.items()})


RUNNERS: Registry[Callable[[Any, State, dict[str, Any]], State]] = Registry("step")


def _objection(kind: str, many: int, before: set[str]) -> str | None:
    """What speaks against so many steps of a kind in a row, after steps of the kinds before."""
    if kind not in NEEDS:
        return f"unknown step {kind!r}"
    if kind not in REPEATABLE and (many > 1 or kind in before):
        return f"a second {kind!r} step"
    needs = NEEDS[kind]
    if needs is not None and before.isdisjoint(needs) and kind not in before:
        return f"{kind!r} needs one of {needs} before it"
    return None


class Plan:
    """Steps in stages: steps of one kind in a row are one. A loader counts as a step that has been done."""

    def __init__(self, steps: Iterable[Step], loader: str | None = None, completed: Iterable[str] = ()) -> None:
        self.stages = [list(run) for _, run in groupby(steps, key=lambda s: s.kind)]
        self.given = frozenset(completed) | ({loader} if loader else frozenset())
        kinds = [stage[0].kind for stage in self.stages]
        for n, (kind, stage) in enumerate(zip(kinds, self.stages, strict=True)):
            said = _objection(kind, len(stage), {*self.given, *kinds[:n]})
            if said:
                raise PlanError(f"{said}, at position {sum(map(len, self.stages[:n]))}")

    def run(self, spark: Any, state: State) -> State:
        return reduce(lambda s, stage: self._after(spark, s, stage), self.stages, state)

    def _after(self, spark: Any, state: State, stage: list[Step]) -> State:
        for step in stage:
            if step.kind == "data_pipe":  # a plan of its own over the same files; its splits come to those that are there
                inner = Plan(step.options["steps"], completed=state.done or REMOTE).run(spark, State(state.folder))
                state = state.having(files=inner.files, rows=inner.rows)
            elif step.kind not in REMOTE:
                state = RUNNERS.get(step.kind)(spark, state, step.options)
        return replace(state, done=state.done | {stage[0].kind})


def split_order(names: Iterable[str]) -> list[str]:
    """train, validation and test first, then others by name."""
    rank = {"train": 0, "validation": 1, "test": 2}
    return sorted(names, key=lambda n: (rank.get(n, 3), n))


def _relative(folder: Path, pattern: str) -> list[str]:
    found = sorted(str(p) for p in folder.glob(pattern))
    if not found:
        raise PlanError(f"no file for {pattern!r}")
    return found


@RUNNERS.register("extract")
def _extract(spark: Any, state: State, options: dict[str, Any]) -> State:
    from ..sources.archives import extract

    extract(state.folder / options["path"], state.folder / options.get("target", "."), options.get("members"))
    return state


@RUNNERS.register("splits")
def _splits(spark: Any, state: State, options: dict[str, Any]) -> State:
    """Globs by split, or by split and role; files are sorted, so that documents are numbered alike each time."""
    found = lambda v: {r: _relative(state.folder, p) for r, p in v.items()} if isinstance(v, dict) else _relative(state.folder, v)
    return state.having(files={split: found(options["splits"][split]) for split in split_order(options["splits"])})


@RUNNERS.register("read_splits")
def _read_splits(spark: Any, state: State, options: dict[str, Any]) -> State:
    """Splits as a file of the corpus has them, under other names if asked for."""
    from ..sources.readers import SPLIT_READERS

    source = options["files"]
    text = lambda name: (state.folder / name).read_text()
    content = {k: text(v) for k, v in source.items()} if isinstance(source, dict) else text(source)
    exists = lambda p: (state.folder / p).exists()
    read = SPLIT_READERS.get(options["reader"])(content, options["folders"], exists)
    whole = lambda files, role: [str(state.folder / f[role]) for f in files]
    names = options.get("names", {})
    return state.having(files={names.get(k, k): {role: whole(v, role) for role in ("text", "annotations")} for k, v in read.items()})


@RUNNERS.register("convert")
def _convert(spark: Any, state: State, options: dict[str, Any]) -> State:
    """Rows of each split by a reader, annotations in order, documents with empty texts left out or refused."""
    from pyspark.sql import functions as F

    from ..functions.spans import ordered
    from ..operators.documents import drop_documents_with_empty_text
    from ..schema import tagsets_of
    from ..sources.readers import READERS

    reader, arguments = READERS.get(options["reader"]), options.get("arguments", {})

    def rows_of(files: Any) -> Any:
        rows = reader(spark, *files.values(), **arguments) if isinstance(files, dict) else reader(spark, files, **arguments)
        rows = rows.withColumns({t: ordered(F.col(t)) for t in tagsets_of(rows.schema)})
        return drop_documents_with_empty_text(rows, ("source", "document"), strict=not options.get("filter_empty_documents", False))

    return replace(state, rows=state.rows | {split: rows_of(files) for split, files in state.files.items()})


@RUNNERS.register("columns")
def _columns(spark: Any, state: State, options: dict[str, Any]) -> State:
    """Parquet files of tokens and tags. With `splits`, names of splits become the usual ones and rows are dealt by language
    (see sources.columnar); a split of a subset or language then stands under subset/name."""
    from ..sources import columnar
    from ..sources.readers import tagged_rows

    arguments = {k: v for k, v in options.items() if k != "splits"}
    tables = {split: spark.read.parquet(*files) for split, files in state.files.items()}
    if "splits" in options:
        dealt = columnar.normalised(tables, columnar.Naming(**options["splits"]))
        tables = {"/".join([*(n for n, _ in part.subset), part.split]): part.rows for part in dealt}
    return replace(state, rows=state.rows | {split: tagged_rows(rows, **arguments) for split, rows in tables.items()})


@RUNNERS.register("metadata")
def _metadata(spark: Any, state: State, options: dict[str, Any]) -> State:
    """Write all splits and the metadata file of the dataset."""
    from pyspark.sql import functions as F

    from ..schema import SEQUENCE_TYPES, tagsets_of
    from ..sources.store import Dataset, Subset, inventories, with_ids, write_split
    from .metadata import cascade

    name, subset, language = options["dataset"], options.get("subset", ""), options["language"]
    out = Path(options["output"], name)
    splits, union = {}, None
    for split in split_order(state.rows):
        rows = with_ids(state.rows[split], name, subset, split)
        if "sequence_type" not in rows.columns:
            rows = rows.withColumn("sequence_type", F.lit(SEQUENCE_TYPES["sentence"]).cast("smallint"))
        tagsets = sorted(tagsets_of(rows.schema))
        tokenized = "tokens" in rows.columns
        out.mkdir(parents=True, exist_ok=True)
        splits[split] = write_split(rows, out, f"{subset or 'all'}-{split}", tagsets, tokenized)
        splits[split].creation_metadata = cascade(options.get("metadata", []), [subset] if subset else [], split)
        part = rows.select(*tagsets, *[f"{t}_iob" for t in tagsets if tokenized])
        union = part if union is None else union.unionByName(part)
    if union is None:
        raise PlanError("no split to write")
    labels, tags = inventories(union, tagsets, tokenized)
    node = Subset(subset, language, tokenized, tagsets, labels, tags, splits)
    Dataset(name, [language], split_order(splits), [node]).dump(out)
    return state

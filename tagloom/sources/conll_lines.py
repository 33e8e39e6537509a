"""The pass over lines of CoNLL files: what each line is follows from the lines before it in its source.

Lines come in order, source after source, in batches; what a batch leaves open (a source, a segment, a document) goes on in the
next. Nothing but the state at the last line is kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions import kernels

_ENDS = "\n\r\u0085  "
#: A comment `# key = value`, as in conll.key_value().
_PAIR = re.compile(rf"^#\s*([^=]+?)\s*=\s*([^{_ENDS}]+?)\s*(?:\r\n|[{_ENDS}])?\Z", re.ASCII)
#: Lines of Unicode white space, in the terms of RE2.
_WHITE = r"^[\s\x0b\x1c-\x1f\x{85}\p{Z}]*$"


def one_character(form: str | None) -> str | None:
    """A character without the number of its place in a word."""
    if form is None:
        return None
    if len(form) > 1 and form[0] not in _ENDS and all(unicodedata.category(c)[0] == "N" for c in form[1:]):
        return form[0]
    lost = re.fullmatch("(�+)[0-9]+", form)
    if lost is None:
        raise ValueError(f"no character with its place: {form}")
    return lost[1]


@dataclass(frozen=True)
class Rules:
    """What a pass must know of a dialect. fields: the number and the rule (None: as it is) of each column."""

    fields: dict[str, tuple[int, Callable[[str | None], str | None] | None]]
    delimiter: str = "\t"
    strict_blank: bool = True
    docstart: str | None = None
    ignore_docstart: bool = True
    comments: bool = False
    document_comment: str | None = None
    whole_source: bool = False


@dataclass
class Tokens:
    """The lines that are tokens: their numbers in the batch, whether a sentence begins there, and what they hold."""

    at: np.ndarray
    opens: np.ndarray
    columns: dict[str, pa.Array] = field(default_factory=dict)


class Lines:
    """A pass. go() takes the next lines, and for each whether it is the first of its source."""

    def __init__(self, rules: Rules):
        self.rules, self.state = rules, {}

    def _starts(self, fresh: np.ndarray) -> np.ndarray:
        """The number of the first line of each line's source; -1 where the source goes on from the batch before."""
        return np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), -1))

    def _count(self, name: str, flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How many lines so far in the source are flagged."""
        total = np.cumsum(flags)
        before = np.where(starts > 0, total[np.maximum(starts - 1, 0)], 0)
        out = total - before + np.where(starts < 0, self.state.get(name, 0), 0)
        self.state[name] = int(out[-1])
        return out

    def _last(self, name: str, flags: np.ndarray, values: np.ndarray, starts: np.ndarray, default: int = -1) -> np.ndarray:
        """The value at the last flagged line so far in the source."""
        at = np.maximum.accumulate(np.where(flags, np.arange(len(flags)), -1))
        inside = (at >= 0) & (at >= starts)
        out = np.where(inside, values[np.maximum(at, 0)], np.where((at < 0) & (starts < 0), self.state.get(name, default), default))
        self.state[name] = int(out[-1])
        return out

    def _before(self, name: str, values: np.ndarray, fresh: np.ndarray, first: int) -> np.ndarray:
        """The value of the line before in the source."""
        out = np.empty(len(values), np.int64)
        out[1:], out[0] = values[:-1], self.state.get(name, first)
        out[fresh] = first
        self.state[name] = int(values[-1])
        return out

    def go(self, line: pa.Array, fresh: np.ndarray) -> Tokens:
        r, n = self.rules, len(line)
        line = pc.fill_null(line, "")
        starts, every = self._starts(fresh), np.arange(n)
        flags = lambda found: found.to_numpy(zero_copy_only=False).astype(bool)
        blank = flags(pc.equal(line, "") if r.strict_blank else pc.match_substring_regex(line, _WHITE))
        new = ~blank & (self._before("blank", blank.astype(np.int64), fresh, 1) == 1)
        segment = self._count("segment", new, starts)
        start = flags(pc.starts_with(line, r.docstart)) if r.docstart and not r.comments else np.zeros(n, bool)
        comment, text, told = np.zeros(n, bool), None, []
        if r.comments:
            # Comments are the lines of # before a segment's first other line.
            marked = flags(pc.starts_with(line, "#"))
            seen = self._last("body", new | (~blank & ~marked), (~marked).astype(np.int64), starts, 0)
            comment = ~blank & (seen == 0)
            here = np.flatnonzero(comment)
            said = dict(zip(here.tolist(), line.take(pa.array(here)).to_pylist(), strict=True))
            found = {i: m[2] for i, c in said.items() if (m := _PAIR.search(c)) and m[1] == "text"}
            is_text, nth = np.zeros(n, bool), np.zeros(n, np.int64)
            is_text[list(found)] = True
            told = [self.state.get("told"), *found.values()]
            nth[list(found)] = np.arange(1, len(found) + 1)
            of = self._last("text_segment", is_text, segment, starts)
            text = np.where(of == segment, self._last("text", is_text, nth, starts, 0), -1)
            self.state |= {"told": told[self.state["text"]], "text": 0}
        if r.whole_source:
            document = np.zeros(n, np.int64)
        elif r.comments and r.document_comment:
            mark = np.zeros(n, bool)
            mark[[i for i, c in said.items() if re.search(r.document_comment, c, re.ASCII)]] = True
            document = self._last("document", mark, segment, starts)
        elif not r.comments and r.docstart and not r.ignore_docstart:
            document = self._last("document", new & start, segment, starts)
        else:
            document = segment
        # An ignored start takes its whole segment with it; else it is a line of its own.
        gone = new & start
        if r.docstart and r.ignore_docstart and not r.comments:
            gone = self._last("opened", new, start.astype(np.int64), starts, 0) == 1
        at = np.flatnonzero(~blank & ~comment & ~gone)
        source = np.cumsum(fresh)
        out = self._numbered(at, source, document[at], segment[at])
        kept = line.take(pa.array(at))
        if text is not None:
            out.columns["sentence_text"] = pa.array(told, pa.string()).take(pa.array(text[at], mask=text[at] < 0))
        cells = pc.split_pattern(kept, r.delimiter)
        flat, first = cells.flatten(), cells.offsets.to_numpy()[:-1] - (cells.offsets[0].as_py() if len(at) else 0)
        size = kernels.sizes(cells)
        for name, (i, rule) in r.fields.items():
            value = flat.take(pa.array(first + i, pa.int64(), mask=size <= i))
            if rule is not None:
                coded = value.dictionary_encode(null_encoding="encode")
                new_values = pa.array([rule(v) for v in coded.dictionary.to_pylist()], pa.string())
                value = new_values.take(coded.indices) if len(value) else value
            out.columns[name] = value
        return out

    def _numbered(self, at: np.ndarray, source: np.ndarray, document: np.ndarray, segment: np.ndarray) -> Tokens:
        """Documents, sentences and positions of the lines that stay, counted from 0."""
        s = self.state
        if not len(at):
            s["has"] = s.get("has", False) and int(source[-1]) == 0
            return Tokens(at, np.zeros(0, bool), {k: pa.array([], pa.int64()) for k in ("document", "sentence", "position")})
        mine = source[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = mine[1:] != mine[:-1]
        fresh[0] = not (s.get("has", False) and mine[0] == 0)
        s["has"] = int(mine[-1]) == int(source[-1])
        starts = self._starts(fresh)
        following = fresh | (self._before("last_document", document, fresh, -2) != document)
        opens = following | (self._before("last_segment", segment, fresh, -2) != segment)
        nth, p = self._count("sentences", opens, starts), self._count("tokens", np.ones(len(at), bool), starts)
        columns = {
            "document": self._count("documents", following, starts) - 1,
            "sentence": nth - self._last("first_sentence", following, nth, starts),
            "position": p - self._last("first_token", opens, p, starts),
        }
        return Tokens(at, opens, {k: pa.array(v, pa.int64()) for k, v in columns.items()})


def firsts(source: pa.Array, before: list) -> np.ndarray:
    """Which rows begin a source; before: the last source so far, if any, which is replaced."""
    coded = source.dictionary_encode(null_encoding="encode")
    code = kernels.numbers(coded.indices)
    fresh = np.ones(len(code), bool)
    fresh[1:] = code[1:] != code[:-1]
    fresh[0] = not before or before[0] != source[0].as_py()
    before[:] = [source[-1].as_py()]
    return fresh


def tokens(rules: Rules) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of source and line, in order, to batches of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, before = Lines(rules), []
        for batch in batches:
            if batch.num_rows:
                got = walk.go(batch.column("line"), firsts(batch.column("source"), before))
                yield _batch(batch.column("source"), got)

    return run


def _batch(source: pa.Array, got: Tokens) -> pa.RecordBatch:
    text = got.columns.pop("sentence_text", None)
    c = {"source": source.take(pa.array(got.at))}
    c |= {k: got.columns.pop(k) for k in ("document", "sentence", "position")}
    c["sentence_text"] = pa.nulls(len(got.at), pa.string()) if text is None else text
    return pa.RecordBatch.from_pydict(c | got.columns)


def sentences(rules: Rules) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same, as one row per sentence with the list x of its tokens; the last sentence of a batch waits for the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, before, open_ = Lines(rules), [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            got = walk.go(batch.column("line"), firsts(batch.column("source"), before))
            if not len(got.at):
                continue
            new, opens = _batch(batch.column("source"), got), np.flatnonzero(got.opens)
            if not len(opens):
                open_.append(new)
                continue
            if open_ or opens[0]:
                open_.append(new.slice(0, opens[0]))
                yield _gathered(pa.Table.from_batches(open_), np.zeros(1, np.int64))
            if len(opens) > 1:
                yield _gathered(pa.Table.from_batches([new.slice(opens[0], opens[-1] - opens[0])]), opens[:-1] - opens[0])
            open_ = [new.slice(opens[-1])]
        if open_:
            yield _gathered(pa.Table.from_batches(open_), np.zeros(1, np.int64))

    return run


def _gathered(rows: pa.Table, first: np.ndarray) -> pa.RecordBatch:
    batch = rows.combine_chunks().to_batches()[0]
    head = batch.take(pa.array(first))
    names = [c for c in batch.schema.names if c not in ("source", "document", "sentence", "sentence_text")]
    each = pa.StructArray.from_arrays([batch.column(c) for c in names], names)
    x = kernels.lists(each, np.diff(np.append(first, batch.num_rows)))
    return pa.RecordBatch.from_arrays([head.column("source"), head.column("document"), head.column("sentence"), head.column("sentence_text"), x], ["source", "document", "sentence", "sentence_text", "x"])


def in_rows(rules: Rules) -> Callable[[pa.Array], pa.Array]:
    """Lists of lines, each a whole source, to lists of tokens."""

    def run(lists: pa.Array) -> pa.Array:
        size = kernels.sizes(lists)
        fresh = np.zeros(int(size.sum()), bool)
        begins = kernels.ends(size)[:-1][size > 0]
        fresh[begins] = True
        if not len(fresh):
            names = ["document", "sentence", "position", *rules.fields]
            kinds = [pa.int64()] * 3 + [pa.string()] * len(rules.fields)
            return kernels.lists(pa.StructArray.from_arrays([pa.array([], k) for k in kinds], names), size, lists)
        got = Lines(rules).go(lists.flatten(), fresh)
        got.columns.pop("sentence_text", None)
        owner = kernels.owners(size)[got.at]
        each = pa.StructArray.from_arrays(list(got.columns.values()), list(got.columns))
        return kernels.lists(each, np.bincount(owner, minlength=len(size)), lists)

    return run


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of doc_idx, sent_idx, form and ner, in order, to batches of tokens; see conll.parse_columns()."""
    walk, before, last = Lines(None), [], None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        number = batch.column("sent_idx")
        fresh, coded = firsts(batch.column("doc_idx"), before), number.dictionary_encode()
        code = kernels.numbers(pc.fill_null(coded.indices, -1))
        new = np.ones(n, bool)
        new[1:] = (code[:-1] < 0) | ((code[1:] >= 0) & (code[1:] != code[:-1]))
        first = number[0].as_py()
        new[0] = last is None or (first is not None and first != last)
        new, last = new | fresh, number[n - 1].as_py()
        starts = walk._starts(fresh)
        p = walk._count("tokens", np.ones(n, bool), starts)
        sentence, position = walk._count("sentences", new, starts) - 1, p - walk._last("first", new, p, starts)
        columns = [pa.array([""] * n), batch.column("doc_idx").cast(pa.int64()), pa.array(sentence), pa.array(position), pa.nulls(n, pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, batch.column("form"), batch.column("ner")], ["source", "document", "sentence", "position", "sentence_text", "form", "ner"])

"""Arrow kernels behind the columns over spans: each takes whole columns of lists and makes one pass over their elements.

Offsets are code points. A list of a batch is its elements in a row and the number of them in each row (`sizes`).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def ends(size: np.ndarray) -> np.ndarray:
    """Where each row's elements begin, and the end of the last."""
    return np.concatenate([[0], np.cumsum(size)])


def owners(size: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(size)), size)


def numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


def lists(values: pa.Array, size: np.ndarray, *nulls: pa.Array) -> pa.Array:
    """Rows of so many elements; null where any of `nulls` is."""
    missing = np.zeros(len(size), bool)
    for column in nulls:
        if column.null_count:
            missing |= column.is_null().to_numpy(zero_copy_only=False)
    mask = pa.array(missing) if missing.any() else None
    return pa.ListArray.from_arrays(pa.array(ends(size).astype(np.int32)), values, mask=mask)


def spans(start: np.ndarray, stop: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(stop, pa.int64())], ["start", "stop"])


def annotations(labels: pa.Array, each: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays([labels.cast(pa.string()), each], ["label", "spans"])


def joined(tokens: pa.Array, between: pa.Array) -> pa.Array:
    """Spans of tokens that are joined by a separator."""
    size, flat = sizes(tokens), tokens.flatten()
    length = numbers(pc.fill_null(pc.utf8_length(flat), 0))
    step = length + np.repeat(numbers(pc.fill_null(pc.utf8_length(between), 0)), size)
    at, first = ends(step), ends(size)
    start = at[:-1] - np.repeat(at[first[:-1]], size)
    return lists(spans(start, start + length), size, tokens, between)


def _cut(values: pa.Array, size: np.ndarray, keep: np.ndarray) -> pa.Array:
    if (size == keep).all():
        return values
    nth = np.arange(int(size.sum())) - np.repeat(ends(size)[:-1], size)
    return values.filter(pa.array(nth < np.repeat(keep, size)))


def tag_parts(tag: str | None) -> tuple[str | None, str | None]:
    """Position and type: what stands before and after the first hyphen."""
    head, hyphen, tail = (tag or "").partition("-")
    return (head if tag is not None else None), (tail if hyphen else None)


_B, _I, _O, _OTHER = range(4)


def entities(tags: pa.Array, token_spans: pa.Array) -> pa.Array:
    """Annotations from tags and the spans of their tokens; the longer list is cut.

    B, O and a change of type end what is open; the first B or I after that opens an entity, which reaches to the last B or I
    before the next end. Other positions neither open nor widen one.
    """
    n, m = sizes(tags), sizes(token_spans)
    size = np.minimum(n, m)
    coded = _cut(tags.flatten(), n, size).dictionary_encode(null_encoding="encode")
    where = _cut(token_spans.flatten(), m, size)
    names = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [tag_parts(t) for t in names]
    types = list(dict.fromkeys(y for _, y in parts if y is not None))
    place = {y: i for i, y in enumerate(types)} | {None: -1}
    position = np.array([{"B": _B, "I": _I, "O": _O}.get(p, _OTHER) for p, _ in parts], np.int8)[code]
    kind = np.array([place[y] for _, y in parts], np.int64)[code]
    closes = (position == _O) | (position == _B)
    closes[1:] |= kind[1:] != kind[:-1]
    begins = ends(size)[:-1]
    closes[begins[size > 0]] = True
    at = np.flatnonzero((position == _B) | (position == _I))
    if (kind[at] < 0).any():
        raise ValueError("a BIO tag has no type")
    run = np.cumsum(closes)[at]
    opens = np.ones(len(at), bool)
    opens[1:] = run[1:] != run[:-1]
    first = at[opens]
    last = at[np.append(np.flatnonzero(opens)[1:], len(at)) - 1] if len(at) else at
    one = spans(numbers(where.field("start"))[first], numbers(where.field("stop"))[last])
    labels = pa.array(types, pa.string()).take(pa.array(kind[first])) if types else pa.array([], pa.string())
    found = annotations(labels, lists(one, np.ones(len(first), np.int64)))
    return lists(found, np.bincount(owners(size)[first], minlength=len(size)), tags, token_spans)


def placed(tokens: pa.Array, texts: pa.Array, place: Callable[[list[str], str], list[int] | None], refuse: bool) -> pa.Array:
    """Spans of tokens whose starts `place` finds in the text of their row; null where it finds none, unless that is refused."""
    size, flat = sizes(tokens), tokens.flatten()
    length = numbers(pc.fill_null(pc.utf8_length(flat), 0))
    words, first = flat.to_pylist(), ends(size)
    starts, keep, missing = np.zeros(len(words), np.int64), size.copy(), np.zeros(len(size), bool)
    for i, text in enumerate(texts.to_pylist()):
        mine = words[first[i] : first[i + 1]]
        found = None if text is None or not tokens[i].is_valid else place(mine, text)
        if found is None:
            if refuse and text is not None and tokens[i].is_valid:
                raise ValueError(f"tokens don't make up the text {text}")
            missing[i], keep[i] = True, 0
        else:
            starts[first[i] : first[i + 1]] = found
    kept = np.repeat(keep > 0, size) if len(size) else np.zeros(0, bool)
    gone = pa.array(np.where(missing, None, 0).tolist(), pa.int8())
    return lists(spans(starts[kept], (starts + length)[kept]), keep, gone)


def in_order(tokens: list[str], text: str) -> list[int] | None:
    """Starts of tokens that make up the text with white space between them."""
    at, out = 0, []
    for token in tokens:
        while at < len(text) and text[at].isspace():
            at += 1
        if at >= len(text) or not text.startswith(token, at):
            return None
        out.append(at)
        at += len(token)
    return out


def one_after_another(tokens: list[str], text: str) -> list[int]:
    """Starts of tokens, each at its first place after the one before."""
    at, out = 0, []
    for token in tokens:
        start = text.find(token, at)
        if start < 0:
            raise ValueError(f"token not in the text: {token}")
        out.append(start)
        at = start + len(token)
    return out


# --- offsets held against what should stand there: (text, start, stop, expected) to (start, stop) ---------------------

Place = tuple[int, int]


def _refuse(where: str, expected: str) -> ValueError:
    return ValueError(f"no such text {where} the offsets: {expected}")


def as_long(text: str, start: int, stop: int, expected: str) -> Place:
    """The span, if the text has what is expected there or something as long."""
    if len(text[start:stop]) != len(expected):
        raise _refuse("at", expected)
    return start, stop


def exact(text: str, start: int, stop: int, expected: str) -> Place:
    """The span, if the text has exactly what is expected there."""
    if text[start:stop] != expected:
        raise _refuse("at", expected)
    return start, stop


def nearest(text: str, start: int, expected: str, most: int = 5) -> Place | None:
    """The nearest span that holds what is expected, but for that at start itself; the earlier one of two as near."""
    starts = (start + s * k for k in range(1, most + 1) for s in (-1, 1))
    return next(((a, a + len(expected)) for a in starts if a >= 0 and text.startswith(expected, a)), None)


def mended(text: str, start: int, stop: int, expected: str, most: int = 5) -> Place:
    """See spans.repaired."""
    found = text[start:stop]
    if found == expected:
        return start, stop
    near, bare = nearest(text, start, expected, most), found.strip()
    if near and stop - start == len(expected):
        return near
    first = start + len(found) - len(found.lstrip())
    inner = found.find(expected)
    if bare != expected and inner >= 0:
        return start + inner, start + inner + len(expected)
    if bare != expected and near:
        return near
    if bare == expected or len(found) != len(expected):
        return first, first + len(bare)
    raise _refuse("near", expected)


def settled(rule: Callable[[str, int, int, str], Place]) -> Callable[[pa.Array, pa.Array], pa.Array]:
    """A kernel for lists of (start, stop, expected) of a text. What is expected to be null stays as it is."""

    def run(texts: pa.Array, items: pa.Array) -> pa.Array:
        size, flat = sizes(items), items.flatten()
        start, stop = numbers(flat.field("start")).tolist(), numbers(flat.field("stop")).tolist()
        wanted, of = flat.field("expected").to_pylist(), texts.to_pylist()
        at = [
            (a, z) if e is None else rule(of[i], a, z, e) for i, a, z, e in zip(owners(size).tolist(), start, stop, wanted, strict=True)
        ]
        first, last = (np.fromiter((x[k] for x in at), np.int64, len(at)) for k in (0, 1))
        return lists(spans(first, last), size, items, texts)

    return run


def pieces(texts: pa.Array, items: pa.Array) -> pa.Array:
    size, flat, of = sizes(items), items.flatten(), texts.to_pylist()
    at = zip(owners(size).tolist(), numbers(flat.field("start")).tolist(), numbers(flat.field("stop")).tolist(), strict=True)
    return lists(pa.array([of[i][a:z] for i, a, z in at], pa.string()), size, items, texts)


def of_bytes(texts: pa.Array, items: pa.Array) -> pa.Array:
    """Spans in bytes of UTF-8 as spans in code points."""
    size, flat = sizes(items), items.flatten()
    at, out = ends(size), []
    start, stop = numbers(flat.field("start")), numbers(flat.field("stop"))
    for i, text in enumerate(texts.to_pylist()):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        part = slice(at[i], at[i + 1])
        out.append((before[np.minimum(start[part], len(raw))], before[np.minimum(stop[part], len(raw))]))
    first, last = (np.concatenate([np.empty(0, np.int64), *(x[k] for x in out)]) for k in (0, 1))
    return lists(spans(first, last), size, items, texts)


def edges(items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The start of the first span and the stop of the last of annotations in a row."""
    held = items.field("spans")
    size, flat = sizes(held), held.flatten()
    if (size == 0).any():
        raise ValueError("an annotation has no span")
    at = ends(size)
    return numbers(flat.field("start"))[at[:-1]], numbers(flat.field("stop"))[at[1:] - 1]


def ordered(items: pa.Array) -> pa.Array:
    """Annotations by the start of the first span, then by the stop of the last; ties keep their order."""
    size, flat = sizes(items), items.flatten()
    start, stop = edges(flat)
    return lists(flat.take(pa.array(np.lexsort((stop, start, owners(size))))), size, items)


def _merged(bounds: pa.Array, tagsets: tuple[pa.Array, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, stops and numbers by row of sentences once those that an annotation crosses are one."""
    size, flat = sizes(bounds), bounds.flatten()
    start, stop, row = numbers(flat.field("start")), numbers(flat.field("stop")), owners(size)
    at = ends(size)
    crossed = np.zeros(len(stop) + 1, np.int64)
    wide = 1 + max([int(x.max()) for x in (stop, start) if len(x)], default=0)
    for items in tagsets:
        first, last = edges(items.flatten())
        of = owners(sizes(items))
        final = np.full(len(size), -1)
        final[size > 0] = stop[at[1:][size > 0] - 1]
        if (last > final[of]).any():
            raise ValueError("an annotation ends after the last sentence")
        # Ends of sentences that lie inside an annotation, of all rows at once: rows are laid one after another.
        keys = row * wide + stop
        np.add.at(crossed, np.searchsorted(keys, of * wide + first, "right"), 1)
        np.add.at(crossed, np.maximum(np.searchsorted(keys, of * wide + last, "left"), np.searchsorted(keys, of * wide + first, "right")), -1)
    final = np.cumsum(crossed[:-1]) == 0
    opens = np.ones(len(stop), bool)
    opens[1:] = final[:-1]
    return start[opens], stop[final], np.bincount(row[final], minlength=len(size))


def merged(bounds: pa.Array, *tagsets: pa.Array) -> pa.Array:
    start, stop, size = _merged(bounds, tagsets)
    return lists(spans(start, stop), size, bounds)


def moved(items: pa.Array, by: np.ndarray) -> pa.Array:
    """Annotations in a row with all offsets moved, each by its own number."""
    held = items.field("spans")
    size, flat = sizes(held), held.flatten()
    each = np.repeat(by, size)
    return annotations(items.field("label"), lists(spans(numbers(flat.field("start")) + each, numbers(flat.field("stop")) + each), size))


def sentences(names: tuple[str, ...]) -> Callable[..., pa.Array]:
    """A kernel that cuts rows into sentences: text, what stands after it, and annotations counted from its start."""

    def run(texts: pa.Array, after: pa.Array, bounds: pa.Array, *tagsets: pa.Array) -> pa.Array:
        """after: what stands after the last sentence of a row."""
        start, stop, size = _merged(bounds, tagsets)
        at, row = ends(size), owners(size)
        cut, gap = [], []
        for i, (text, tail) in enumerate(zip(texts.to_pylist(), after.to_pylist(), strict=True)):
            a, z = start[at[i] : at[i + 1]].tolist(), stop[at[i] : at[i + 1]].tolist()
            text = text or ""
            cut += [text[x:y] for x, y in zip(a, z, strict=True)]
            gap += [text[x:y] for x, y in zip(z, a[1:], strict=False)]
            gap += [tail] if a else []
        last = np.zeros(len(row), bool)
        last[at[1:][size > 0] - 1] = True
        columns = [pa.array(cut, pa.string()), pa.array(gap, pa.string())]
        wide = 1 + max([int(x.max()) for x in (start, stop) if len(x)], default=0)
        for items in tagsets:
            flat, of = items.flatten(), owners(sizes(items))
            first, _ = edges(flat)
            mine = np.searchsorted(row * wide + start, of * wide + np.minimum(first, wide - 1), "right") - 1
            inside = mine >= 0
            inside[inside] = (row[mine[inside]] == of[inside]) & ((first[inside] < stop[mine[inside]]) | last[mine[inside]])
            kept = np.flatnonzero(inside)
            kept = kept[np.argsort(mine[kept], kind="stable")]
            own = mine[kept]
            columns.append(lists(moved(flat.take(pa.array(kept)), -start[own]), np.bincount(own, minlength=len(row))))
        return lists(pa.StructArray.from_arrays(columns, ["text", "space_after", *names]), size, bounds, texts)

    return run


def sentences_of_words(words: pa.Array, bounds: pa.Array, items: pa.Array) -> pa.Array:
    """Texts of sentences that are ranges of words, and the annotations of each in offsets from its start; annotations are ranges
    of words too, and one that lies in no sentence is refused."""
    size, held = sizes(words), sizes(bounds)
    flat, of = bounds.flatten(), owners(sizes(items))
    start, stop, row = numbers(flat.field("start")), numbers(flat.field("stop")), owners(held)
    inner = items.flatten()
    first, last = edges(inner)
    wide = 1 + max([int(x.max()) for x in (start, stop, first) if len(x)], default=0)
    mine = np.searchsorted(row * wide + start, of * wide + first, "right") - 1
    lost = mine < 0
    lost[~lost] = (row[mine[~lost]] != of[~lost]) | (last[~lost] > stop[mine[~lost]])
    if lost.any() or (last > size[of]).any():
        raise ValueError("an entity lies in no sentence")
    # Offsets of words, and of the end after the last, in the words of all rows joined by a blank.
    length = numbers(pc.fill_null(pc.utf8_length(words.flatten()), 0))
    at, begins = ends(length + 1), ends(size)
    from_ = at[np.minimum(begins[row] + start, begins[row + 1])]
    to = np.where(stop > start, at[np.minimum(begins[row] + stop, begins[row + 1])] - 1, from_)
    whole = [" ".join(w or "" for w in t or ()) for t in words.to_pylist()]
    cut = [whole[i][a:z] for i, a, z in zip(row.tolist(), (from_ - at[begins[row]]).tolist(), (to - at[begins[row]]).tolist(), strict=True)]
    each = spans(at[begins[of] + first] - from_[mine], at[begins[of] + last] - 1 - from_[mine])
    order = np.argsort(mine, kind="stable")
    made = annotations(inner.field("label"), lists(each, np.ones(len(mine), np.int64))).take(pa.array(order))
    after = np.full(len(row), " ", object)
    after[ends(held)[1:][held > 0] - 1] = ""
    columns = [pa.array(cut, pa.string()), pa.array(after, pa.string()), lists(made, np.bincount(mine, minlength=len(row)))]
    return lists(pa.StructArray.from_arrays(columns, ["text", "space_after", "ner"]), held, words, bounds)


def assigned(found: pa.Array, bounds: pa.Array) -> pa.Array:
    """For each sentence the numbers of the spans that begin in it; one that reaches beyond its sentence is refused."""
    size, flat, held = sizes(bounds), bounds.flatten(), sizes(found)
    inner = found.flatten()
    start, stop, row = numbers(flat.field("start")), numbers(flat.field("stop")), owners(size)
    first, last, of = numbers(inner.field("start")), numbers(inner.field("stop")), owners(held)
    wide = 1 + max([int(x.max()) for x in (start, stop, first) if len(x)], default=0)
    mine = np.searchsorted(row * wide + start, of * wide + first, "right") - 1
    inside = mine >= 0
    inside[inside] = (row[mine[inside]] == of[inside]) & (first[inside] < stop[mine[inside]])
    kept = np.flatnonzero(inside)
    if (last[kept] > stop[mine[kept]]).any():
        raise ValueError("a token reaches beyond its sentence")
    nth = np.arange(len(of)) - ends(held)[:-1][of]
    return lists(lists(pa.array(nth[kept].astype(np.int32)), np.bincount(mine[kept], minlength=len(row))), size, found, bounds)


def by_value(values: pa.Array, table: Callable[[str | None], str | None]) -> pa.Array:
    """Strings in lists, each put through a function that runs once for each different one."""
    coded = values.flatten().dictionary_encode(null_encoding="encode")
    new = pa.array([table(v) for v in coded.dictionary.to_pylist()], pa.string())
    return lists(new.take(coded.indices) if len(new) else new, sizes(values), values)

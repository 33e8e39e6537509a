"""Columns over spans and annotations: arrays of struct(label, spans), with offsets in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ANNOTATIONS, SPAN
from . import kernels
from .passes import arrow
from .text import UNSPACED, piece, primary_language

_SPANS = f"array<{SPAN.simpleString()}>"
_ANNOTATIONS = ANNOTATIONS.simpleString()


def span(start: Column, stop: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"))


def annotation(label: Column, spans: Column) -> Column:
    return F.struct(label.alias("label"), spans.alias("spans"))


def none() -> Column:
    return F.array().cast(_ANNOTATIONS)


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once; inside a lambda an expression would be worked out for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bio_to_spans(tags: Column, spans: Column) -> Column:
    """Annotations from tags and the spans of their tokens, in one Arrow pass; the longer array is cut.

    An I without a B before it, or after another type, begins an entity; a B or I without a type stops the job. Tags of other
    positions than B, I and O neither begin nor widen an entity, and end one of another type.
    """
    return arrow(kernels.entities, _ANNOTATIONS)(tags, spans)


def any_tags_to_spans(tags: Column, spans: Column) -> Column:
    """The same under the name that sources with tags of other positions use."""
    return bio_to_spans(tags, spans)


def _aligned(refuse: bool):
    return arrow(lambda tokens, texts: kernels.placed(tokens, texts, kernels.in_order, refuse), _SPANS)


def align_tokens(tokens: Column, text: Column) -> Column:
    """The spans of tokens that make up the text in order, with white space between them; null where they don't."""
    return _aligned(False)(tokens, text)


def align_tokens_strictly(tokens: Column, text: Column) -> Column:
    """The same; tokens that don't make up the text stop the job."""
    return _aligned(True)(tokens, text)


def find_tokens(tokens: Column, text: Column) -> Column:
    """The spans of tokens, each found at its first place after the one before; one that isn't found stops the job."""
    run = arrow(lambda tokens, texts: kernels.placed(tokens, texts, kernels.one_after_another, True), _SPANS)
    return run(tokens, text)


def separator(language: Column, concatenate: bool = False) -> Column:
    """What stands between tokens: nothing in languages written without blanks, whatever their script suffix."""
    return F.lit("") if concatenate else F.when(primary_language(language).isin(*UNSPACED) | language.isin(*UNSPACED), "").otherwise(" ")


def hash_as_blank(tokens: Column, language: Column) -> Column:
    """Tokens # as blanks, in languages written without blanks."""
    blank = F.transform(tokens, lambda t: F.when(t == "#", " ").otherwise(t))
    return F.when(primary_language(language).isin(*UNSPACED), blank).otherwise(tokens)


def joined_spans(tokens: Column, between: Column) -> Column:
    """The spans of tokens once they are joined by a separator."""
    return arrow(kernels.joined, _SPANS)(tokens, between)


def ordered(annotations: Column) -> Column:
    """By the start of the first span, then by the stop of the last; ties keep their order."""
    return arrow(kernels.ordered, _ANNOTATIONS)(annotations)


def continuous(annotations: Column) -> Column:
    """Annotations of exactly one span, as struct(label, spans: one span)."""
    one = F.filter(annotations, lambda a: F.size(a["spans"]) == 1)
    return F.transform(one, lambda a: F.struct(a["label"].alias("label"), a["spans"][0].alias("spans")))


def shifted(annotations: Column, by: Column) -> Column:
    """All offsets moved by a number."""
    return F.transform(
        annotations,
        lambda a: annotation(a["label"], F.transform(a["spans"], lambda s: span(s["start"] + by, s["stop"] + by))),
    )


def pieces(text: Column, spans: Column) -> Column:
    """What the text has at each of an array of spans."""
    return arrow(kernels.pieces, "array<string>")(text, spans)


def expecting(start: Column, stop: Column, expected: Column) -> Column:
    """An item of the lists below; where expected is null the span is taken as it is."""
    return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"), expected.alias("expected"))


def _settled(rule, text: Column, items: Column) -> Column:
    return arrow(kernels.settled(rule), _SPANS)(text, items)


def check_spans(text: Column, items: Column) -> Column:
    """The spans of items, where the text has what is expected or something as long; another length stops the job."""
    return _settled(kernels.as_long, text, items)


def check_exactly(text: Column, items: Column) -> Column:
    """The spans of items, where the text has exactly what is expected; anything else stops the job."""
    return _settled(kernels.exact, text, items)


def repair_spans(text: Column, items: Column) -> Column:
    """The spans of items as they are if right. One as long as what is expected moves to the nearest place that holds it. Else white
    space is taken off its ends, or the expected text found within, or near its start. A span of another length that can't be
    mended keeps what is left without white space at its ends; one of the same length stops the job."""
    return _settled(kernels.mended, text, items)


def check_span(text: Column, start: Column, stop: Column, expected: Column) -> Column:
    """check_spans() for one span."""
    return F.get(check_spans(text, F.array(expecting(start, stop, expected))), F.lit(0))


def check_exact(text: Column, start: Column, stop: Column, expected: Column) -> Column:
    """check_exactly() for one span."""
    return F.get(check_exactly(text, F.array(expecting(start, stop, expected))), F.lit(0))


def repaired(text: Column, start: Column, stop: Column, expected: Column) -> Column:
    """repair_spans() for one span."""
    return F.get(repair_spans(text, F.array(expecting(start, stop, expected))), F.lit(0))


def find_near(text: Column, start: Column, stop: Column, expected: Column, most: int = 5) -> Column:
    """The nearest span of the same length that holds what is expected, the earlier one of two as near; null without one."""
    moves = F.array(*[F.lit(s * d) for d in range(1, most + 1) for s in (-1, 1)])
    fits = F.filter(moves, lambda d: (start + d >= 0) & (piece(text, start + d, stop + d) == expected))
    return F.when(F.size(fits) > 0, span(start + fits[0], stop + fits[0]))


def spans_of_bytes(text: Column, items: Column) -> Column:
    """Spans counted in bytes of UTF-8, as spans in code points."""
    return arrow(kernels.of_bytes, _SPANS)(text, items)


def merged_bounds(bounds: Column, tagsets: list[Column]) -> Column:
    """Sentences in order, of which two become one where an annotation of any tagset crosses the end between them.

    An annotation that begins where a sentence ends belongs to the next. One that reaches beyond the last stops the job.
    """
    return arrow(kernels.merged, _SPANS)(bounds, *tagsets)


def sentences(text: Column, after: Column, bounds: Column, tagsets: dict[str, Column]) -> Column:
    """An array of the sentences of a row, merged as above: struct(text, space_after, and each tagset with offsets counted
    from the sentence's start). The blanks between sentences become space_after; after the last one stands `after`."""
    kind = "".join(f", `{name}`: {_ANNOTATIONS}" for name in tagsets)
    run = arrow(kernels.sentences(tuple(tagsets)), f"array<struct<text: string, space_after: string{kind}>>")
    return run(text, after, bounds, *tagsets.values())

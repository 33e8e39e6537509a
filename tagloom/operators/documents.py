"""Operators over whole documents: merging with moved spans, budgets, sentence splits, detokenising."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions import spans as sp
from ..functions.passes import arrow
from ..schema import ANNOTATIONS, DEFAULT_TAGSET
from .boundaries import numbered

_ANNOTATIONS = ANNOTATIONS.simpleString()


def budget_segments(rows: DataFrame, tokens: Column, target: int, keys: tuple[str, ...] = ("document_index",)) -> DataFrame:
    """Adds segment_id: the running number of tokens in the document, divided by the target. A segment may exceed it."""
    order = W.partitionBy(*keys).orderBy("document_position")
    return rows.withColumn("segment_id", F.floor(F.sum(tokens).over(order) / F.lit(target)).cast("long"))


def merge_documents(
    rows: DataFrame, keys: tuple[str, ...] = ("document_index",), tagset: str | None = DEFAULT_TAGSET, by_segment: bool = False
) -> DataFrame:
    """One row per document, or per segment of one: keys, sequence_id of the first row, text, and annotations moved along.

    rows: keys, document_position, sequence_id, text, space_after, and the tagset. One shuffle by the keys; offsets and texts
    come from the same group, so nothing is joined. Documents without annotations have an empty list.
    """
    group = (*keys, "segment_id") if by_segment else keys
    with_tags = tagset is not None and tagset in rows.columns
    whole = F.concat("text", "space_after")
    order = W.partitionBy(*group).orderBy("document_position").rowsBetween(W.unboundedPreceding, -1)
    moved = rows.withColumn("_whole", whole).withColumn("_at", F.coalesce(F.sum(F.length(whole)).over(order), F.lit(0)))
    parts = [F.col("document_position").alias("p"), F.col("_whole").alias("t"), F.col("sequence_id").alias("i")]
    if with_tags:
        parts.append(F.coalesce(sp.shifted(F.col(tagset), F.col("_at")), sp.none()).cast(_ANNOTATIONS).alias("a"))
    grouped = moved.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("x"))
    out = [
        *(F.col(c) for c in group),
        F.col("x")[0]["i"].alias("sequence_id"),
        F.array_join(F.transform("x", lambda x: x["t"]), "").alias("text"),
    ]
    if with_tags:
        out.append(F.flatten(F.transform("x", lambda x: x["a"])).alias(tagset))
    return grouped.select(*out)


def with_chunk_index(merged: DataFrame, order: tuple[str, ...] = ("document_index",), partition: tuple[str, ...] = ()) -> DataFrame:
    """Numbers merged documents from 0 in an explicit order, which begins with the document's number, within each partition (such
    as dataset, subset, split)."""
    return numbered(merged, (*partition, order[0]), order[1:], "chunk_index")


def drop_documents_with_empty_text(rows: DataFrame, keys: tuple[str, ...] = ("document_index",), strict: bool = False) -> DataFrame:
    """Documents of which any row has an empty text go as a whole; strictly, they stop the job."""
    empty = F.max(F.col("text") == "").over(W.partitionBy(*keys))
    if strict:
        return rows.withColumn("text", F.when(empty, F.raise_error(F.lit("a document has an empty text"))).otherwise(F.col("text")))
    return rows.withColumn("_empty", empty).where(~F.col("_empty")).drop("_empty")


def split_sentences(
    rows: DataFrame,
    bounds: str = "sentence_offsets",
    tagsets: tuple[str, ...] = (DEFAULT_TAGSET,),
    keys: tuple[str, ...] = ("document_index",),
    keep_type: bool = False,
) -> DataFrame:
    """One row per sentence, with annotations counted from its start; sentences merge where an annotation crosses their end.

    The blanks between sentences of a row become space_after; after the last one it is empty, or with keep_type the row's own.
    document_position is counted anew over the sentences of a document.
    """
    after = F.col("space_after") if keep_type else F.lit("")
    cut = sp.sentences(F.col("text"), after, F.col(bounds), {t: F.col(t) for t in tagsets})
    left = [c for c in rows.columns if c not in {"text", "space_after", "document_position", bounds, *tagsets}]
    # Sentences are cut before they become rows, so that no row carries the whole text.
    each = rows.select(*left, "document_position", F.posexplode(cut).alias("_k", "_s"))
    nth = F.row_number().over(W.partitionBy(*keys).orderBy("document_position", "_k")) - 1
    new = {"text": F.col("_s.text"), "space_after": F.col("_s.space_after"), "document_position": nth.cast("long")}
    new |= {t: F.col("_s")[t] for t in tagsets}
    if "sequence_type" in rows.columns and not keep_type:
        new["sequence_type"] = F.lit(0).cast("smallint")
    return each.select(*[new.get(c, F.col(c)).alias(c) for c in rows.columns if c != bounds])


def assign_tokens(tokens: Column, text: Column, bounds: Column) -> Column:
    """For each sentence, the array of the numbers of its tokens; a token across an end stops the job."""
    return arrow(kernels.assigned, "array<array<int>>")(sp.find_tokens(tokens, text), bounds)


def split_by(text: Column, splitter: Callable[[str], list[str]]) -> Column:
    """Sentence offsets by a splitter of one's own, such as a model: it gives the sentences of a text in order, in Arrow batches.
    White space at their ends is left out, and so are empty ones."""

    def run(texts: pa.Array) -> pa.Array:
        told = [None if t is None else [s.strip() for s in splitter(t) if s.strip()] for t in texts.to_pylist()]
        return pa.array(told, pa.list_(pa.string()))

    return sp.find_tokens(arrow(run, "array<string>")(text), text)


def rule_sentences(text: Column) -> Column:
    """Sentence offsets by rule: after . ! or ? and white space, or at a line end. Stands in where no model is at hand."""
    parts = F.filter(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda s: F.length(F.trim(s)) > 0)
    return sp.find_tokens(parts, text)


def detokenize(rows: DataFrame, language: Column, tagsets: tuple[str, ...] = (DEFAULT_TAGSET,), original: str | None = None, kind: str = "join") -> DataFrame:
    """Adds text and annotations to rows of tokens and tags (<tagset>_iob).

    kind: join, concatenate, or hashes (tokens # are blanks in languages written without them). Where an original text is
    given and the tokens make it up, it is used, and else tokens are joined.
    """
    tokens = F.col("tokens")
    if kind == "hashes":
        rows = rows.withColumn("tokens", sp.hash_as_blank(tokens, language))
    between = sp.separator(language, kind == "concatenate")
    # concat_ws and array_join take a fixed separator in SQL; a column goes through the two cases.
    joined = F.when(between == "", F.array_join(tokens, "")).otherwise(F.array_join(tokens, " "))
    rows = rows.withColumn("_spans", sp.joined_spans(tokens, between)).withColumn("_text", joined)
    if original:
        aligned = sp.align_tokens(tokens, F.col(original))
        rows = rows.withColumn("_aligned", aligned)
        rows = rows.withColumn("_text", F.when(F.col("_aligned").isNotNull(), F.col(original)).otherwise(F.col("_text")))
        rows = rows.withColumn("_spans", F.coalesce("_aligned", "_spans")).drop("_aligned")
    rows = rows.withColumns({t: sp.bio_to_spans(F.col(f"{t}_iob"), F.col("_spans")) for t in tagsets})
    return rows.withColumn("text", F.col("_text")).drop("_spans", "_text")

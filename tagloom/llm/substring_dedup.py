"""Substring deduplication over windows of a fixed number of words, by Rabin-Karp hashes counted in Spark.

A window is hashed by polynomials over its words, rolled along the document. Hashes are counted over all documents; words
under a window that also starts in a document with a smaller id go, as maximal intervals.

Most windows occur once. To keep these out of the shuffle, each window is named by the least hash among its runs of `anchor`
words. Equal windows have equal names, so a window whose name no second document has can't repeat; only the names, some one
in thirteen words, are counted first. What may repeat is then hashed and counted window by window, so no repetition is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crowded, hashed_words, hot_keys, join_skewed, keep, may_contain, membership, rolled, spread, steps, table, text_or_empty, tidy

WINDOW = 50
#: Bytes of text of one step here; windows take several times the memory of their text.
STEP = 1 << 20
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values."""
    out, length = values, 1
    while length * 2 <= width:
        out, length = np.minimum(out[:-length], out[length:]), length * 2
    rest = width - length
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class _Document:
    """The hashes of one batch of documents, along all their words in a row."""

    def __init__(self, texts: pa.Array, window: int, anchor: int) -> None:
        self.spread = hashed_words(texts)
        self.offsets, self.words = self.spread.offsets, self.spread.hashes
        self.window = window
        n = max(0, len(self.words) - window + 1)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.offsets))[:n]
        self.whole = np.arange(n) + window <= self.offsets[1:][self.owner]
        self.names = least(rolled(self.words, anchor, _BASES[1]), window - anchor + 1)[:n] if n else np.empty(0, np.uint64)

    def hashes(self, which: int) -> np.ndarray:
        """The hash of the window that begins at each word, by one of two bases."""
        return rolled(self.words, self.window, _BASES[which])

    def digests(self) -> list[int]:
        """A hash of each document's words, which tells apart rows that share an id."""
        return [hash_bytes(self.words[a:b]) for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True)]


def hash_bytes(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            d = _Document(batch.column("text"), window, anchor)
            names, owner = d.names[d.whole], d.owner[d.whole]
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
            names, owner = names[new], owner[new]
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(names.view(np.int64)))], ["id", "names"]
            )

    return docs.mapInArrow(tidy(run), "id long, names array<long>")


_WINDOWS = "id long, bare boolean, text_key long, n_words long, full_sha string, windows array<struct<h1: long, h2: int>>"


def _windows(docs: DataFrame, shared: bytes | None, window: int, anchor: int) -> DataFrame:
    """Per row: a digest, its number of words, the SHA-256 of its words, and the distinct hashes of windows whose name several
    ids have. Such names are known by a filter, or else stand in each row (docs: names, null for none)."""
    bitmap = docs.sparkSession.sparkContext.broadcast(shared) if shared is not None else None

    def likely(d: _Document, batch: pa.RecordBatch) -> np.ndarray:
        if bitmap is not None:
            return may_contain(np.frombuffer(bitmap.value, np.uint8), d.names)
        out = np.zeros(len(d.names), bool)
        bounds = np.searchsorted(d.owner, np.arange(batch.num_rows + 1))
        for i, own in enumerate(batch.column("names").to_pylist()):
            if own:
                part = slice(bounds[i], bounds[i + 1])
                out[part] = np.isin(d.names[part].view(np.int64), np.array(own, np.int64))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            d = _Document(batch.column("text"), window, anchor)
            at = np.flatnonzero(d.whole & likely(d, batch))
            owner, first = d.owner[at], d.hashes(0)[at].view(np.int64)
            order = np.lexsort((first, owner))  # a text that repeats itself has many windows of one hash
            new = np.ones(len(order), bool)
            new[1:] = (first[order][1:] != first[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            at, owner, first = (x[order[new]] for x in (at, owner, first))
            second = (d.hashes(1)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(first), pa.array(second)], ["h1", "h2"])
            whole, starts = d.spread.joined()
            ends = starts[d.offsets].tolist()
            digests = [hashlib.sha256(whole[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("bare"),
                    pa.array(d.digests(), pa.int64()),
                    pa.array(np.diff(d.offsets)),
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(pa.array(bounds), rows),
                ],
                ["id", "bare", "text_key", "n_words", "full_sha", "windows"],
            )

    return docs.mapInArrow(tidy(run), _WINDOWS)


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int | None = None) -> tuple[DataFrame, DataFrame]:
    """docs: id, bare (whether the row has no id), text. Rows with their digests and sizes, and the hashes of windows that also start under a smaller id."""
    anchor = anchor or max(1, window // 2)
    names = _anchors(docs, window, anchor).select("id", F.explode("names").alias("name"))
    several = names.groupBy("name").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    shared: bytes | None = membership(several, "name")
    if crowded(shared):
        # Rows carry their own names: as many as a thirteenth of their words, of which only those that repeat.
        held = join_skewed(names, several.select("name"), "name", hot_keys(names, "name")).groupBy("id").agg(F.collect_set("name").alias("names"))
        docs, shared = docs.join(held, "id", "left"), None
    rows = keep(_windows(docs, shared, window, anchor), "windows")
    flat = rows.select("id", "text_key", F.inline("windows"))
    firsts = flat.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    again = flat.join(firsts.drop("high"), ["h1", "h2"]).where("id > low").select("id", "text_key", "h1")
    return rows, again


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, kept_text (null where nothing was removed), removed.

    removed lists maximal intervals of word positions, [start, stop). Ids are integers; a null id counts as larger than any
    other. Null texts have no words. Rows that share an id remove nothing from each other; rows equal in id and text give
    equal rows. Other columns are not read. An empty table gives an empty result.
    """
    top = (1 << 63) - 1
    docs = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(top)).alias("id"), F.col(id_col).isNull().alias("bare"), text_or_empty(text_col).alias("text")
    )
    rows, again = repeated_windows(docs, window, anchor)
    hit = keep(again.groupBy("id", "text_key").agg(F.collect_list("h1").alias("hashes")), "repeats")
    wanted, some = membership(hit.select(spread("id").alias("key")), "key"), docs
    if crowded(wanted):
        some = docs.join(hit.select("id").distinct(), "id", "left_semi")
    met = docs.sparkSession.sparkContext.broadcast(wanted)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(met.value, np.uint8)
        for batch in batches:
            batch = batch.filter(pa.array(may_contain(bits, batch.column("key").to_numpy())))
            for part in steps([batch], "text", STEP):
                d = _Document(part.column("text"), window, window)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(d.digests(), pa.int64()), part.column("text")], ["id", "text_key", "text"]
                )

    texts = some.select("id", "text", spread("id").alias("key")).mapInArrow(tidy(touched), "id long, text_key long, text string")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            out = []
            for text, hashes in zip(rows["text"], rows["hashes"], strict=True):
                d = _Document(pa.array([text]), window, window)
                starts = np.flatnonzero(np.isin(d.hashes(0).view(np.int64), np.asarray(hashes, np.int64)))
                fresh = np.r_[True, starts[1:] > starts[:-1] + window]
                begins, ends = starts[fresh], (starts + window)[np.r_[fresh[1:], True]]
                left = np.ones(len(d.words), bool)
                for a, b in zip(begins, ends, strict=True):
                    left[a:b] = False
                whole, places = d.spread.joined()
                kept = whole[np.repeat(left, np.diff(places))][:-1].tobytes()
                spans = [{"start": int(a), "stop": int(b)} for a, b in zip(begins, ends, strict=True)]
                out.append((int((~left).sum()), hashlib.sha256(kept).hexdigest(), kept.decode(), spans))
            columns = ["n_removed", "kept_sha256", "kept_text", "removed"]
            yield pd.concat([rows[["id", "text_key"]].reset_index(drop=True), pd.DataFrame(out, columns=columns)], axis=1)

    schema = "id long, text_key long, n_removed long, kept_sha256 string, kept_text string, removed array<struct<start: int, stop: int>>"
    done = texts.join(hit, ["id", "text_key"]).mapInPandas(tidy(cut), schema).dropDuplicates(["id", "text_key"])
    whole = rows.select("id", "bare", "text_key", "n_words", "full_sha").join(done, ["id", "text_key"], "left")
    return whole.select(
        F.when(~F.col("bare"), F.col("id")).alias(id_col),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "full_sha").alias("kept_sha256"),
        "kept_text",
        F.coalesce("removed", F.array().cast("array<struct<start: int, stop: int>>")).alias("removed"),
    )


SQL = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
),
t as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as i from w),
k as (select doc_id, i, word, string_agg(word, ' ') over f as span, count(*) over f as size
      from t window f as (partition by doc_id order by i rows between current row and 49 following)),
low as (select span, min(doc_id) as low from k where size = 50 group by span),
r as (select k.doc_id, k.i, k.word, coalesce(low.low < k.doc_id, false) as again from k left join low on k.span = low.span and k.size = 50),
g as (select doc_id, i, word, bool_or(again) over (partition by doc_id order by i rows between 49 preceding and current row) as gone from r)
select d.doc_id, count(g.i) as n_words, count(*) filter (g.gone) as n_removed,
       sha256(coalesce(string_agg(g.word, ' ' order by g.i) filter (not g.gone), '')) as kept_sha256
from documents d left join g using (doc_id) group by d.doc_id
"""


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")

"""Packing of documents into sequences of a fixed number of tokens, by the sum-of-squares rule.

Each document goes where the sum, over the gaps, of the squared number of open bins with that gap becomes smallest: into a
bin with some gap, or into a new one. Pieces are dealt by hash into shards of about `shard_pieces`, and each shard is packed
on its own; the bins left open at the end of a shard are the only loss, some ten in several thousand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, steps, table, text_or_empty, tidy
from .token_ids import Encoder, default_tokenizer, with_end

CAPACITY = 2048
SHARD_PIECES = 40_000


def cut(
    docs: DataFrame,
    tokenizer: str,
    end: int = 0,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, nth (of the partition's pieces), piece, start, length, ids_crc32. Only a document of more than `capacity` ids is cut."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            *(T.StructField(c, T.LongType()) for c in ("nth", "piece", "start", "length", "ids_crc32")),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder.of(tokenizer), 0
        for batch in steps(batches, "text"):
            row, piece, start, length, crc = [], [], [], [], []
            flat, bounds = with_end(*encoder.encode(batch.column("text")), end)
            for i, (begin, stop) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                for k, at in enumerate(range(0, stop - begin, capacity)):
                    part = flat[begin + at : min(begin + at + capacity, stop)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            nth = pa.array(range(seen, seen + len(row)), pa.int64())
            seen += len(row)
            numbers = [pa.array(x, pa.int64()) for x in (piece, start, length, crc)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row, pa.int64())), nth, *numbers], schema.fieldNames()
            )

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(tidy(run), schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item, and its place there. Items come in the order given; among equally good gaps the smallest is taken."""
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    grows = np.zeros(capacity + 1, np.int64)  # what one more bin of each gap adds, less 1 for a gap of none
    opened = 0
    big = np.iinfo(np.int64).max // 4
    gain = np.full(capacity + 1, big, np.int64)  # what taking a bin of each gap adds; none is open yet
    for i, size in enumerate(lengths.tolist()):
        costs = gain[size:capacity] + grows[: capacity - size]
        best = int(costs.argmin()) if len(costs) else 0
        fresh = grows[capacity - size]
        if len(costs) and costs[best] < big // 2 and costs[best] <= fresh:
            gap = best + size
            at = stacks[gap].pop()
            count[gap] -= 1
            c = int(count[gap])
            gain[gap], grows[gap] = (1 - 2 * c if c else big), 2 * c + 1
        else:
            gap, at, opened = capacity, opened, opened + 1
        bins[i], offsets[i] = at, capacity - gap
        left = gap - size
        if left:
            stacks[left].append(at)
            count[left] += 1
            c = int(count[left])
            gain[left], grows[left] = 1 - 2 * c, 2 * c + 1
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end: int = 0,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty and hold the end id alone. Rows that share an id are packed each on its own; a null id is kept
    as it is. Other columns are not read. An empty table gives an empty result. No sequence has more than `capacity` ids,
    places in a sequence are gapless from 0, and sequence ids differ between shards.
    """
    pieces = keep(cut(docs, tokenizer or default_tokenizer(), end, capacity, id_col, text_col), "pieces")
    shards = max(1, ceil(pieces.count() / shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "nth", "piece"), F.lit(shards)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "ids_crc32", "nth"], ascending=[False, True, True], kind="stable")
        at, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.drop(columns="shard").assign(sequence_id=(int(key[0]) << 32) + at, offset=offset)

    packed = dealt.groupBy("shard").applyInPandas(run, schema)
    return packed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

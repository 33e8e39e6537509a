"""A content-addressed store of token ids.

A rolling hash cuts each document's ids into chunks where its content says so; each distinct chunk is stored once under its
SHA-256 digest. A document's recipe lists its chunks. Digests make a Merkle tree: chunks under documents, documents under
parts, parts under the store; reading checks it from the chunks up.

The files, all Parquet, in one folder:
  blocks/kind=chunk   key (digest), data (ids as little-endian unsigned 16- or 32-bit integers, by `wide` in the manifest)
  recipes             part, doc_id, start, n_tokens, chunks, root; parts in ascending order of doc_id, and so are rows within
  manifest            part, root, n_documents, n_tokens, wide
blocks/kind=recipe holds the recipes as they came, before they were ordered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hot_keys, join_skewed, mixed, new_folder, rolled, steps, table, text_or_empty, tidy
from .token_ids import Encoder, default_tokenizer, with_end

END = 2
#: Ids that the rolling hash sees, the mean distance of cuts less MIN_IDS, and the bounds of a chunk's ids.
WINDOW, MEAN_BITS, MIN_IDS, MAX_IDS = 16, 8, 64, 2048
#: Documents of one part of the recipes, about.
PART_DOCUMENTS = 50_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def cuts(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """The ends of each document's chunks, counted from its own begin. They depend on the WINDOW ids before them and on the
    chunk's length only."""
    marks = np.flatnonzero(rolled(mixed(ids.astype(np.uint64)), WINDOW, _BASE) >> np.uint64(64 - MEAN_BITS) == 0) + WINDOW
    first = np.searchsorted(marks, bounds[:-1] + WINDOW)  # a window lies within one document
    last = np.maximum(first, np.searchsorted(marks, bounds[1:]))
    places, out = marks.tolist(), []
    for begin, end, i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), first.tolist(), last.tolist(), strict=True):
        found, at = [], begin
        for mark in [*places[i:j], end]:
            while mark - at > MAX_IDS:
                at += MAX_IDS
                found.append(at - begin)
            if mark - at >= MIN_IDS and mark < end:
                found.append(mark - begin)
                at = mark
        if end > at:
            found.append(end - begin)
        out.append(found)
    return out


def _block_schema(kind: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("doc_id", kind),
            T.StructField("nth", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("chunks", T.ArrayType(T.BinaryType())),
            T.StructField("data", T.BinaryType()),
        ]
    )


def _root(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests)).digest()


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode whole texts, cut, and write the store to a new folder.

    Null texts count as empty; each text gets the end id, so no document is without a chunk. Rows that share an id are
    documents of their own, in the order of their digests; null ids come first. Other columns are not read. An empty table
    gives a store without chunks.
    """
    from tokenizers import Tokenizer

    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    tokenizer = tokenizer or default_tokenizer()
    wide = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end + 1) > 1 << 16
    schema = _block_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stored, nth = Encoder.of(tokenizer), set(), 0
        for batch in steps(batches, "text"):
            recipes: list[tuple[int, int, list[bytes]]] = []
            fresh: list[tuple[bytes, bytes]] = []
            ids, bounds = with_end(*encoder.encode(batch.column("text")), end)
            packed, width = ids.astype("<u4" if wide else "<u2").tobytes(), 4 if wide else 2
            for begin, stop, found in zip(bounds[:-1].tolist(), bounds[1:].tolist(), cuts(ids, bounds), strict=True):
                digests, last = [], 0
                for at in found:
                    data = packed[(begin + last) * width : (begin + at) * width]
                    digest = hashlib.sha256(data).digest()
                    digests.append(digest)
                    if digest not in stored:  # copies within a task go before the shuffle
                        stored.add(digest)
                        fresh.append((digest, data))
                    last = at
                recipes.append((nth, stop - begin, digests))
                nth += 1
            if len(stored) > 1_000_000:
                stored.clear()
            n, m = len(recipes), len(fresh)
            none = pa.nulls(m, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["recipe"] * n + ["chunk"] * m),
                    pa.array([_root(d) for _, _, d in recipes] + [k for k, _ in fresh], pa.binary()),
                    pa.concat_arrays([batch.column("id"), pa.nulls(m, batch.column("id").type)]),
                    pa.concat_arrays([pa.array([x for x, _, _ in recipes], pa.int64()), none]),
                    pa.concat_arrays([pa.array([x for _, x, _ in recipes], pa.int64()), none]),
                    pa.array([d for _, _, d in recipes] + [None] * m, pa.list_(pa.binary())),
                    pa.array([None] * n + [d for _, d in fresh], pa.binary()),
                ],
                schema.fieldNames(),
            )

    found = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(tidy(run), schema)
    # Recipes of equal texts share a root; their salt keeps them from meeting in one task.
    salt = F.when(F.col("kind") == "recipe", F.pmod(F.xxhash64("doc_id", "nth"), F.lit(1 << 20))).otherwise(F.lit(-1))
    near = W.partitionBy("key", "salt").orderBy("kind")
    placed = found.withColumn("salt", salt).withColumn("copy", F.row_number().over(near))
    once = placed.where((F.col("kind") == "recipe") | (F.col("copy") == 1)).drop("salt", "copy")
    once.write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/blocks")

    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    recipes = blocks.where("kind = 'recipe'").select("doc_id", "n_tokens", "chunks", F.col("key").alias("root"))
    parts = max(1, ceil(recipes.count() / PART_DOCUMENTS))
    ranged = recipes.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "root")
    ranged.withColumn("part", F.spark_partition_id()).write.option("compression", "zstd").parquet(f"{path}/ranged")
    ranged = spark.read.schema(T.StructType([*ranged.schema.fields, T.StructField("part", T.IntegerType())])).parquet(f"{path}/ranged")
    totals = ranged.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per part
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    base = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    inside = W.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "root").rowsBetween(W.unboundedPreceding, -1)
    started = ranged.join(base, "part").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    columns = ("part", "doc_id", "start", "n_tokens", "chunks", "root")
    started.select(*columns).repartitionByRange(parts, "part", "start").sortWithinPartitions("part", "start").write.option(
        "compression", "zstd"
    ).parquet(f"{path}/recipes")
    # One row for each part; digests are gathered part by part before.
    _part_roots(_recipes(spark, path, kind)).withColumn("wide", F.lit(wide)).repartition(1).write.parquet(f"{path}/manifest")


def _recipes(spark: SparkSession, path: str, kind: T.DataType) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("doc_id", kind),
            *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens")),
            T.StructField("chunks", T.ArrayType(T.BinaryType())),
            T.StructField("root", T.BinaryType()),
        ]
    )
    return spark.read.schema(schema).parquet(f"{path}/recipes")


def _part_roots(recipes: DataFrame) -> DataFrame:
    """Digest over the documents of each part, in their order; a part has about PART_DOCUMENTS."""
    leaf = F.sort_array(F.collect_list(F.struct("start", F.hex("root").alias("root"))))
    root = F.sha2(F.array_join(F.transform(leaf, lambda x: x["root"]), "").cast("binary"), 256)
    return recipes.groupBy("part").agg(
        root.alias("root"), F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens")
    )


def store_root(spark: SparkSession, path: str) -> str:
    """The digest of the whole store, over its parts' roots. As many rows as the store has parts."""
    parts = spark.read.parquet(f"{path}/manifest").orderBy("part").collect()
    return hashlib.sha256("".join(r.root for r in parts).encode()).hexdigest()


class _Shift:
    """crc32 of a text from the crc32 of its parts: what n further zero bytes make of a checksum, as a 32 x 32 bit matrix."""

    def __init__(self) -> None:
        row = np.zeros(32, np.uint64)
        row[0] = 0xEDB88320
        row[1:] = np.uint64(1) << np.arange(31, dtype=np.uint64)
        self._powers = [row]  # of one bit, two bits, four bits ...
        self._known: dict[int, np.ndarray] = {}

    @staticmethod
    def apply(matrix: np.ndarray, value: np.ndarray) -> np.ndarray:
        """matrix: (..., 32) columns; value: as many checksums."""
        bits = (value[..., None] >> np.arange(32, dtype=np.uint64)) & np.uint64(1)
        return np.bitwise_xor.reduce(np.where(bits > 0, matrix, np.uint64(0)), axis=-1)

    def of(self, n_bytes: int) -> np.ndarray:
        if n_bytes not in self._known:
            out, left, k = np.uint64(1) << np.arange(32, dtype=np.uint64), 8 * n_bytes, 0
            while left:
                while len(self._powers) <= k:
                    self._powers.append(self.apply(self._powers[-1][None, :], self._powers[-1]))
                if left & 1:
                    out = self.apply(self._powers[k][None, :], out)
                left, k = left >> 1, k + 1
            self._known[n_bytes] = out
        return self._known[n_bytes]


def joined_crcs(crcs: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The checksum of each document from those of its chunks, in order, and their numbers of ids; all documents side by side."""
    kinds, which = np.unique(sizes, return_inverse=True)
    shift = _Shift()
    matrices = np.stack([shift.of(4 * int(n)) for n in kinds]) if len(kinds) else np.zeros((0, 32), np.uint64)
    many = np.diff(bounds)
    order = np.argsort(-many, kind="stable")
    first, many = bounds[:-1][order], many[order]
    value = np.zeros(len(order), np.uint64)
    for k in range(int(many[0]) if len(many) else 0):
        n = int(np.searchsorted(-many, -k, side="left"))  # documents of more than k chunks
        at = first[:n] + k
        value[:n] = shift.apply(matrices[which[at]], value[:n]) ^ crcs[at].astype(np.uint64)
    out = np.empty(len(order), np.int64)
    out[order] = value.astype(np.int64)
    return out


def _chunk_facts(blocks: DataFrame, wide: bool) -> DataFrame:
    """key, crc (of the ids as unsigned 32-bit integers), n. A chunk whose digest isn't its key stops the job."""
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, crcs, sizes = batch.column("key").to_pylist(), [], []
            for key, data in zip(keys, batch.column("data").to_pylist(), strict=True):
                if hashlib.sha256(data).digest() != key:
                    raise ValueError(f"chunk {key.hex()} is damaged")
                ids = np.frombuffer(data, "<u4" if wide else "<u2").astype("<u4")
                crcs.append(zlib.crc32(ids.tobytes()))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(crcs, pa.int64()), pa.array(sizes, pa.int64())], ["key", "crc", "n"]
            )

    return blocks.where("kind = 'chunk'").select("key", "data").mapInArrow(tidy(run), "key binary, crc long, n long")


def _checked(spark: SparkSession, path: str, kind: T.DataType) -> tuple[DataFrame, DataFrame, bool]:
    """Recipes, blocks and width of a store whose upper levels agree with its manifest."""
    recipes = _recipes(spark, path, kind)
    manifest = spark.read.parquet(f"{path}/manifest")
    wrong = _part_roots(recipes).alias("a").join(manifest.alias("b"), "part", "full").where("not (a.root <=> b.root)")
    if wrong.limit(1).count():
        raise ValueError("the recipes don't agree with the manifest")
    first = manifest.select("wide").first()
    blocks = spark.read.schema(_block_schema(kind)).parquet(f"{path}/blocks")
    return recipes, blocks, bool(first and first.wide)


def _references(recipes: DataFrame) -> DataFrame:
    sound = F.sha2(F.unhex(F.array_join(F.transform("chunks", F.hex), "")), 256) == F.lower(F.hex("root"))
    safe = F.when(sound, F.col("chunks")).otherwise(F.raise_error(F.lit("a recipe doesn't agree with its root")))
    return recipes.select("doc_id", "start", "n_tokens", F.posexplode(safe).alias("at", "key"))


def read_digests(spark: SparkSession, path: str, kind: T.DataType | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone; every level of the tree is checked.

    Checksums of chunks are combined, so chunks themselves aren't shuffled again.
    """
    recipes, blocks, wide = _checked(spark, path, kind or T.LongType())
    facts = _chunk_facts(blocks, wide)
    references = _references(recipes)
    met = join_skewed(references, facts, "key", hot_keys(references.select("key"), "key"), "left")
    whole = F.when(F.col("n").isNull(), F.raise_error(F.lit("a chunk is missing"))).otherwise(F.col("n"))
    by_doc = met.groupBy("start", "doc_id", "n_tokens").agg(
        F.sort_array(F.collect_list(F.struct("at", "crc", whole.alias("n")))).alias("parts")
    )
    schema = T.StructType([*by_doc.drop("parts").schema.fields, T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("parts")
            parts, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
            sizes = parts.field("n").to_numpy()
            total = np.r_[0, np.cumsum(sizes)][bounds - bounds[0]]
            if (np.diff(total) != batch.column("n_tokens").to_numpy()).any():
                raise ValueError("a recipe's chunks don't add up to its length")
            crcs = joined_crcs(parts.field("crc").to_numpy(), sizes, bounds - bounds[0])
            kept = [batch.column(c) for c in ("start", "doc_id", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(crcs, pa.int64())], schema.fieldNames())

    return by_doc.mapInArrow(tidy(run), schema).select("doc_id", "start", "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, kind: T.DataType | None = None) -> DataFrame:
    """doc_id, start, ids (array of long) of each document, rebuilt from recipes and chunks."""
    recipes, blocks, wide = _checked(spark, path, kind or T.LongType())
    chunks = blocks.where("kind = 'chunk'").select("key", "data")
    references = _references(recipes)
    by_doc = (
        join_skewed(references, chunks, "key", hot_keys(references.select("key"), "key"))
        .groupBy("start", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "data"))).alias("parts"))
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind = "<u4" if wide else "<u2"
        for rows in frames:
            ids = [np.concatenate([np.frombuffer(p["data"], kind) for p in parts]).astype(np.int64) for parts in rows["parts"]]
            yield rows.drop(columns="parts").assign(ids=ids)

    schema = T.StructType([*by_doc.drop("parts").schema.fields, T.StructField("ids", T.ArrayType(T.LongType()))])
    return by_doc.mapInPandas(tidy(run), schema).select("doc_id", "start", "ids")


def op5_token_store(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = new_folder(spark, "token-store")
    write_store(docs, path)
    return read_digests(spark, path, docs.schema["doc_id"].dataType)

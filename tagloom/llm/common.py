"""What the operators of this subpackage share: shared storage, word splitting in Arrow, bounded membership filters."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java form of the class of separators: blank, and the controls from tab to carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that one step of a Python operator holds.
STEP_BYTES = 4 << 20
#: Bytes of a batch that Spark hands to a Python function: somewhat less than a step, as the last row may exceed it.
BATCH_BYTES = STEP_BYTES * 7 // 8
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tagloom-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may have ended before
        pass


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the program ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_quietly, spark, path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


@contextlib.contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run in this block go as soon as the query is done; nothing reads them again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def keep(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df to the shared folder and read it back. This cuts the lineage: a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with dropping_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    _PATHS[kept] = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Remove tables that keep() wrote, once all that reads them has been written itself."""
    for df in kept:
        remove(df.sparkSession, _PATHS.pop(df))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def crc_remainder(column: str, by: int) -> Column:
    """crc32 of the id as text, modulo by. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % by


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about limit bytes of text, and `rows` rows at most; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part, nth = np.cumsum(size) // limit, np.arange(len(size)) // rows
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (nth[1:] != nth[:-1])])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def bound_batches(spark: SparkSession) -> None:
    """From here on, what this session runs hands Python functions BATCH_BYTES of rows at once, or what the session set, if less.
    Spark gathers up to 64 MB otherwise, outside the heap, and the buffer doubles as it grows; each worker then holds two
    such batches, whatever its steps. The setting stays, as results are run after the function that made them; no result depends on it."""
    said = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH))
    if not 0 < said <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def give_back() -> None:
    """Return memory that this process has freed to the system, where the system's library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches that gives memory back at the end of its partition. Workers outlive tasks, and several wait on each
    executor; what they have freed but hold would add up."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return whole


class Words(NamedTuple):
    """codes: of all words of all texts in a row, into vocabulary; offsets: where each text begins, and the end."""

    codes: np.ndarray
    offsets: np.ndarray
    vocabulary: pa.Array


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words are runs of anything but blanks and the controls from tab to carriage return. Null texts have none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    real = pc.greater(pc.binary_length(flat), 0)
    if len(flat) and not pc.all(real).as_py():
        running = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
        flat, bounds = flat.filter(real), running[bounds].astype(np.int64)
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), bounds, coded.dictionary)


_ROW = 64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A random number for each byte at each place of a row, and a factor for each row of a word.
_PLACES = np.random.default_rng(20_000).integers(0, 1 << 64, (_ROW, 256), dtype=np.uint64).reshape(-1)
with np.errstate(over="ignore"):
    _FACTORS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(1 << 14, np.uint64(0x9E3779B97F4A7C15))]), dtype=np.uint64)


class Spread(NamedTuple):
    """Bytes of all texts in a row (in lower case if asked for); the places of those in words; where in these each word begins
    (with the end); how many words stand before each text (with the end); and a 64-bit hash of each word."""

    raw: np.ndarray
    place: np.ndarray
    begins: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words as bytes, each with a blank after it, and where each begins (with the end)."""
        starts = self.begins + np.arange(len(self.begins))
        out = np.full(starts[-1], 32, np.uint8)
        mask = np.ones(len(out), bool)
        mask[starts[1:] - 1] = False
        out[mask] = self.raw[self.place]
        return out, starts


def hashed_words(texts: pa.Array, lower: bool = False) -> Spread:
    """The words of split_words by their hashes alone, from the bytes of the texts: no string is made."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(texts) and texts.buffers()[2] else np.empty(0, np.uint8)
    ends = ends - ends[0]
    if lower:
        raw = _LOWER[raw]
    inside = ~_IS_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    texts_begin = ends[:-1][ends[:-1] < len(raw)]
    begins[texts_begin] = inside[texts_begin]
    narrow = np.int32 if len(raw) < 1 << 24 else np.int64
    place = np.flatnonzero(inside).astype(narrow)
    first = np.flatnonzero(begins[place])
    size = np.diff(np.append(first, len(place)))
    at = np.arange(len(place), dtype=narrow) - np.repeat(first.astype(narrow), size)
    values = _PLACES[((at & (_ROW - 1)) << 8) + raw[place]]
    with np.errstate(over="ignore"):
        if len(size) and size.max() > _ROW:
            far = np.flatnonzero(at >= _ROW)
            values[far] *= _FACTORS[np.minimum(at[far] // _ROW, len(_FACTORS) - 1)]
        sums = np.add.reduceat(values, first) if len(first) else np.empty(0, np.uint64)
        hashes = mixed(sums + size.astype(np.uint64))
    return Spread(raw, place, np.append(first, len(place)), np.searchsorted(place[first], ends), hashes)


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word of an array, the same as in hashed_words. An empty word has one of its own."""
    found = hashed_words(words)
    size = np.diff(found.offsets)
    if (size > 1).any():
        raise ValueError("these aren't words")
    out = np.full(len(size), np.uint64(0x2545F4914F6CDD1D))
    out[size > 0] = found.hashes
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def rolled(values: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """The polynomial hash of each run of `width` values, by a rolling sum of powers modulo 2**64."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out, span, shift = np.zeros(n, np.uint64), values.copy(), base
        # Runs of doubling length: run(2k)[i] = run(k)[i] * base**k + run(k)[i + k].
        length, done = 1, 0
        while True:
            if width & length:
                out = out * shift + span[done : done + n]
                done += length
            if length * 2 > width:
                break
            span = span[:-length] * shift + span[length:]
            shift, length = shift * shift, length * 2
        return mixed(out)


# --- membership filters of a fixed size --------------------------------------------------------------------------

#: Bits of a filter, whose size never grows, and the share of them that may be set. Beyond that, some nine million keys, it lets
#: too many rows pass to be of use, and keys are joined instead.
FILTER_BITS, FILTER_FULL = 26, 0.125
_PAGE = 32768


def membership(df: DataFrame, column: str, bits: int = FILTER_BITS) -> bytes:
    """A bitmap in which the low bits of each 64-bit key are set; built by Spark's bitmap aggregates, of 2**bits bits at most."""
    bit = F.col(column).cast("long").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    pages = (
        df.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
    )
    out = bytearray((1 << bits) // 8 + _PAGE // 8)
    with dropping_shuffles(df.sparkSession):
        for row in pages.collect():  # 2**bits / 32768 pages of 4 KB at most
            at = (row.page - 1) * (_PAGE // 8)
            out[at : at + len(row.bitmap)] = row.bitmap
    return bytes(out)


def crowded(bitmap: bytes) -> bool:
    """Whether a bitmap is too full to be of use."""
    bits = np.frombuffer(bitmap, np.uint8)
    return int(np.bitwise_count(bits).sum(dtype=np.int64)) > FILTER_FULL * 8 * len(bits)


def may_contain(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may have been in the table; never false for one that was. The bitmap as numpy bytes."""
    bits = (len(bitmap) - _PAGE // 8) * 8
    low = keys.view(np.uint64) & np.uint64(bits - 1)
    return (bitmap[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def most_frequent(counted: DataFrame, column: str, at_most: int) -> DataFrame:
    """The rows of the largest counts, at most so many: those whose count reaches a bound. The bound comes from a histogram of
    a thousand bins or so, so nothing is sorted and no task gets all rows; a bin that doesn't fit as a whole stays out."""
    bin_ = F.floor(F.log(F.col(column).cast("double")) * 64)
    with dropping_shuffles(counted.sparkSession):
        bins = {r.bin: r.n for r in counted.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n")).collect()}
    bound, total = None, 0
    for name in sorted((b for b in bins if b is not None), reverse=True):
        total += bins[name]
        if total > at_most:
            break
        bound = name
    return counted.where(bin_ >= bound) if bound is not None else counted.where("false")


# --- joins on keys of which a few hold much of the rows --------------------------------------------------------------

#: Rows of one key that make it hot, and how many hot keys every task knows at most, those of most rows.
HOT_ROWS, HOT_KEYS = 10_000, 100_000


def hot_keys(df: DataFrame, key: str) -> DataFrame | None:
    """The keys of many rows: a table of HOT_KEYS rows at most, or None where there is none."""
    counted = keep(df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS), "hot")
    return most_frequent(counted, "n", HOT_KEYS).select(key) if counted.limit(1).count() else None


def join_skewed(big: DataFrame, small: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """big joined with small, which has one row for each key. Rows of hot keys stay where they are: what they meet is sent to
    all tasks, a row for each of HOT_KEYS keys at most. how: inner or left."""
    if hot is None:
        return big.join(small, key, how)
    hot = F.broadcast(hot)
    near = big.join(hot, key, "left_semi").join(F.broadcast(small.join(hot, key, "left_semi")), key, how)
    return near.unionByName(big.join(hot, key, "left_anti").join(small, key, how))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, dealt out where its files make fewer tasks than there are cores; that only happens to small inputs."""
    rows, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def spread(column: str) -> Column:
    """A 64-bit key for a filter from a column of any type."""
    return F.xxhash64(F.col(column))

"""Toxicity by two interpolated Kneser-Ney bigram models, one of toxic and one of ordinary texts.

Of each class c, with n(v, w) the count of a bigram (a text's first word follows a start mark), and D the discount:

    P(w | v) = max(n(v, w) - D, 0) / n(v, any) + D * kinds(v, any) / n(v, any) * P(w)
    P(w)     = max(kinds(any, w) - D, 0) / kinds(any, any) + D * words / kinds(any, any) * S(w)
    S(w)     = (kinds of both classes together (any, w) + 1/2) / (kinds of both (any, any) + (V + 1) / 2)

where kinds counts different bigrams and words the different second words. S is shared by the classes and holds one unknown
word, so a rare expression gets the same small probability from both and only what a class has shown moves the score.

What is compared are log-likelihoods per word: of the whole text by P(w | v), and by the continuation probabilities P(w) of the
whole text and of its segments, since an insult in a long text is lost in the mean, and stands after words that the sample hasn't
seen. The largest difference of a segment counts, for each length in SEGMENTS. A logistic fit turns the differences into a
score. It learns from texts that the counts haven't seen: the sample is dealt into folds, and each is weighed by counts of the
others. Scores then come from the counts that leave the last fold out, which have seen as much as those of the fit.

Labelled texts are a sample with a bound for each class (`per_class`), those of the smallest hashes, all of whose words and
bigrams are kept. In the fit a row stands for as many labels of its class as were drawn from, so that the score doesn't move
with the bound. Counting and weighing run in one task a fold; the driver passes the model on as bytes. Every text is scored,
and whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_remainder, give_back, hash_words, keep, split_words, steps, table, text_or_empty, tidy

PER_CLASS, FOLDS = 4000, 4
#: Bytes of text of one step; log ratios take several times the memory of their text.
STEP = 2 << 20
DISCOUNT, PENALTY = 0.75, 0.3
SEGMENTS = (1, 8)
FEATURES = 2 + len(SEGMENTS)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def clean(word: str) -> str:
    """Lower case, without what isn't a letter or a digit at either end."""
    return _EDGES.sub("", word.lower()) or "."


def cleaned(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of all cleaned words, where each text begins (with the end), and the distinct words."""
    codes, offsets, vocabulary = split_words(texts)
    place: dict[str, int] = {}
    table = np.fromiter((place.setdefault(clean(w), len(place)) for w in vocabulary.to_pylist()), np.int64, len(vocabulary))
    return table[codes], offsets, list(place)


class Model(NamedTuple):
    """words: sorted hashes of known words, whose numbers are their places; the next number, V, is the unknown word, and as a
    context the start of a text. All others are log ratios, toxic over ordinary: alone of P(w), back of the weight that a
    context leaves to P(w), bigram of P(w | v) for those of `keys`, v * V + w in order."""

    words: np.ndarray
    alone: np.ndarray
    back: np.ndarray
    keys: np.ndarray
    bigram: np.ndarray


def packed(model: Model) -> bytes:
    size = np.array([len(model.words), len(model.keys)], np.int64)
    return b"".join(x.tobytes() for x in (size, model.words, model.keys, model.alone, model.back, model.bigram))


def unpacked(raw: bytes) -> Model:
    """The model that packed() made, as views of its bytes."""
    words, keys = np.frombuffer(raw, np.int64, 2).tolist()
    at, out = 16, []
    for kind, many in ((np.int64, words), (np.int64, keys), (np.float32, words + 1), (np.float32, words + 1), (np.float32, keys)):
        out.append(np.frombuffer(raw, kind, many, at))
        at += out[-1].nbytes
    return Model(out[0], out[2], out[3], out[1], out[4])


def hashed(words: list[str]) -> np.ndarray:
    return hash_words(pa.array(words, pa.string())).view(np.int64)


def numbers(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The number of each known word, and that after the last for others."""
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, len(known))


def continuation(seen: np.ndarray, shared: np.ndarray, discount: float = DISCOUNT) -> np.ndarray:
    """P(w) of a class from its numbers of different bigrams that end in each word; they sum to 1."""
    total = seen.sum()
    if not total:
        return shared
    return np.maximum(seen - discount, 0) / total + np.minimum(seen, discount).sum() / total * shared


def before(offsets: np.ndarray, words: np.ndarray, start: int) -> np.ndarray:
    """The word before each word; `start` before a text's first."""
    out = np.concatenate([[start], words[:-1]])[: len(words)]
    out[offsets[:-1][offsets[:-1] < len(words)]] = start
    return out


def count(texts: pa.Array, toxic: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bigrams as hashes of both words (`start` before a text's first), their marks and counts."""
    codes, offsets, vocabulary = cleaned(texts)
    names = np.append(hashed(vocabulary), start)
    mark = np.repeat(toxic.astype(np.int64), np.diff(offsets))
    key, n = np.unique((before(offsets, codes, len(vocabulary)) * len(names) + codes) * 2 + mark, return_counts=True)
    pair = key // 2
    return names[pair // len(names)], names[pair % len(names)], (key % 2).astype(np.int8), n.astype(np.int32)


def fit(texts: pa.Array, toxic: np.ndarray, discount: float = DISCOUNT) -> Model:
    """The model of texts and their marks, 0 or 1. Texts are counted a few megabytes at a time."""
    start = int(hash_words(pa.array([""])).view(np.int64)[0])  # no word is empty
    marked = pa.record_batch({"text": texts.cast(pa.string()), "y": pa.array(toxic.astype(np.int64))})
    counted = [count(b.column("text"), b.column("y").to_numpy(), start) for b in steps([marked], "text", STEP)]
    first, second, mark, n = (np.concatenate(x) for x in zip(*counted, strict=True)) if counted else [np.empty(0, np.int64)] * 4
    del counted
    known = np.unique(np.concatenate([first[first != start], second]))
    size = len(known)
    pair = numbers(known, first) * max(size, 1) + numbers(known, second)
    del first, second
    keys = np.unique(pair)
    nth = np.searchsorted(keys, pair)
    del pair
    v, w = keys // max(size, 1), keys % max(size, 1)
    left = np.bincount(w, minlength=size + 1)
    shared = (left + 0.5) / (left.sum() + 0.5 * (size + 1))
    ratio = []
    for c in (0, 1):
        held = np.bincount(nth[mark == c], n[mark == c], len(keys))
        follow, kinds = np.bincount(v, held, size + 1), np.bincount(v, np.minimum(held, discount), size + 1)
        weight = np.where(follow > 0, kinds / np.maximum(follow, 1), 1.0)
        alone = continuation(np.bincount(w, held > 0, size + 1), shared, discount)
        bigram = np.maximum(held - discount, 0) / np.maximum(follow[v], 1) + weight[v] * alone[w]
        ratio = [np.log(x) - (ratio[i] if c else 0) for i, x in enumerate((alone, weight, bigram))]
    alone, back, bigram = (x.astype(np.float32) for x in ratio)
    return Model(known, alone, back, keys, bigram)


def ratios(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word the log ratio by its bigram and alone, and where each text begins (with the end). A context that isn't
    known leaves all its weight to P(w) in both classes."""
    codes, offsets, vocabulary = cleaned(texts)
    size = len(model.words)
    words = numbers(model.words, hashed(vocabulary))[codes]
    alone = model.alone[words].astype(np.float64)
    context = before(offsets, words, size)
    first = np.zeros(len(words), bool)
    first[offsets[:-1][offsets[:-1] < len(words)]] = True
    strange = (context == size) & ~first
    pairs = np.where(strange, 0, model.back[context]) + alone
    if len(model.keys):
        key = context * size + words
        at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        hit = (model.keys[at] == key) & ~strange & (words < size)
        pairs[hit] = model.bigram[at[hit]]
    return pairs, alone, offsets


def features(model: Model, texts: pa.Array) -> np.ndarray:
    """Per text: the mean log ratio by bigrams, the mean by words alone, and the largest mean of a segment of each length. A
    shorter segment, at the end of a text, is filled up with words that say nothing."""
    pairs, alone, offsets = ratios(model, texts)
    size = np.diff(offsets)
    out = np.zeros((len(size), FEATURES))
    full = np.flatnonzero(size > 0)
    if not len(full):
        return out
    out[full, 0] = np.add.reduceat(pairs, offsets[full]) / size[full]
    out[full, 1] = np.add.reduceat(alone, offsets[full]) / size[full]
    sums = np.concatenate([[0], np.cumsum(alone)])
    for k, length in enumerate(SEGMENTS):
        step = max(1, length // 2)
        many = -(-size[full] // step)
        first = np.concatenate([[0], np.cumsum(many)])
        begin = np.repeat(offsets[full] - first[:-1] * step, many) + np.arange(first[-1]) * step
        end = np.minimum(begin + length, np.repeat(offsets[1:][full], many))
        out[full, 2 + k] = np.maximum.reduceat((sums[end] - sums[begin]) / length, first[:-1])
    return out


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, stands_for: np.ndarray | None = None) -> np.ndarray:
    """Weights and the constant, by Newton's steps; without examples of both classes the constant alone. stands_for: how
    many labels each example stands for; only the proportions count."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    if len(np.unique(y)) < 2:
        w[-1] = 3.0 if y[0] else -3.0
        return w
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    of = np.ones(len(y)) if stands_for is None else stands_for * (len(y) / stands_for.sum())
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (of * p * (1 - p))[:, None]) + ridge, x.T @ (of * (y - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _usable(labels: DataFrame) -> DataFrame:
    return labels.where("y in (0, 1) and id is not null").groupBy("id").agg(F.max("y").cast("int").alias("y"))


def _labelled(docs: DataFrame, labels: DataFrame, per_class: int, salt: int) -> DataFrame:
    """text, y, fold of a bounded sample of labelled rows, one for each id; docs and labels: id, and text or y."""
    rows = _usable(labels)
    # The window is over rows that the limits have already cut to a few thousand.
    nth = F.row_number().over(W.partitionBy("y").orderBy("h", "id"))
    top = [rows.where(F.col("y") == c).withColumn("h", F.xxhash64("id", F.lit(salt))).orderBy("h", "id").limit(per_class) for c in (0, 1)]
    sample = top[0].unionByName(top[1]).withColumn("fold", F.pmod(nth, F.lit(FOLDS)).cast("int")).drop("h")
    met = docs.join(F.broadcast(sample), "id")  # 2 * per_class rows at most
    return met.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"), F.first("fold").alias("fold"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, salt: int = 5) -> tuple[bytes, np.ndarray]:
    """The packed model, and the weights of the logistic fit. docs: id, text; labels: id, y."""
    seen = keep(_labelled(docs, labels, per_class, salt).select("id", "text", "y", "fold"), "labelled")
    each = seen.withColumn("out", F.explode(F.array(*map(F.lit, range(FOLDS)))))

    def weigh(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        rest, held = rows[rows["fold"] != key[0]], rows[rows["fold"] == key[0]]
        model = fit(pa.array(rest["text"], pa.string()), rest["y"].to_numpy())
        parts = [features(model, part.column("text")) for part in steps([pa.record_batch({"text": pa.array(held["text"], pa.string())})], "text")]
        x = np.concatenate([np.zeros((0, FEATURES)), *parts])
        out = pd.DataFrame({"y": held["y"].astype("int32"), "x": list(x), "model": None})
        if key[0] == FOLDS - 1:
            out = pd.concat([out, pd.DataFrame({"y": [-1], "x": [np.zeros(0)], "model": [packed(model)]})], ignore_index=True)
        del model, rest, held, parts, rows
        give_back()
        return out

    found = each.groupBy("out").applyInPandas(weigh, "y int, x array<double>, model binary")
    found = keep(found, "weighed")
    told = found.where("y = -1").select("model").first()
    raw = bytes(told[0]) if told else packed(fit(pa.array([], pa.string()), np.zeros(0)))
    rows = found.where("y >= 0").select("y", "x").toPandas()
    many = {r.y: r.n for r in _usable(labels).groupBy("y").agg(F.count("*").alias("n")).collect()}
    stands_for = np.array([many.get(y, 0) / max(1, min(many.get(y, 0), per_class)) for y in (0, 1)])
    y = rows["y"].to_numpy(np.int64)
    x = np.array(rows["x"].tolist(), float).reshape(-1, FEATURES)
    return raw, logistic(x, y.astype(float), stands_for=stands_for[y])


class _Scorer:
    """Log odds of texts. The driver and each worker hold the model once, as bytes."""

    def __init__(self, spark, raw: bytes, weights: np.ndarray) -> None:
        self.shared, self.weights = spark.sparkContext.broadcast(raw), weights

    def __call__(self, texts: pa.Array) -> np.ndarray:
        return features(unpacked(self.shared.value), texts) @ self.weights[:-1] + self.weights[-1]


def _scorer(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str, label_col: str, folds: int) -> _Scorer:
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(crc_remainder("id", folds) != 0)
    return _Scorer(docs.sparkSession, *train(rows, marks, per_class))


def score(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
) -> DataFrame:
    """One row per input row: id, held_out, score, predicted. Only labels whose crc32(id as text) mod `folds` isn't 0 are learnt.

    Null and empty texts get the score of a text without evidence. Labels other than 0 and 1, or without an id, aren't used;
    an id labelled both ways counts as toxic. Without labels every score is a half. Rows that share an id are scored each on
    its own, and one of them, the least text, is learnt from. Other columns aren't read.
    """
    log_odds = _scorer(docs, labels, per_class, id_col, text_col, label_col, folds)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            p = 1 / (1 + np.exp(-np.clip(log_odds(batch.column("text")), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(p)], schema.fieldNames())

    scored = rows.select("id", (crc_remainder("id", folds) == 0).alias("held_out"), "text").mapInArrow(tidy(run), schema)
    return scored.select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
) -> DataFrame:
    """The rows of docs whose score is below a half, with all their columns, whatever their names; the text goes through
    Python once, in place.

    Rows go by their own text alone: equal texts go or stay together, and a null id keeps a row from nothing. Null and empty
    texts go only if a text without evidence would. Without labels every score is a half, which isn't below it, and all rows
    would go; so without a usable label, or with labels of one kind alone, all rows stay. An empty table stays empty.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(crc_remainder("id", folds) != 0)
    if marks.where("y in (0, 1) and id is not null").select("y").distinct().count() < 2:
        return docs
    log_odds = _scorer(docs, labels, per_class, id_col, text_col, label_col, folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text_col, STEP):
            yield batch.filter(pa.array(log_odds(batch.column(text_col)) < 0))

    return docs.mapInArrow(tidy(run), docs.schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

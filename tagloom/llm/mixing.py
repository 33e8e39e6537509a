"""Mixing to target weights with soft membership in domains.

A classifier learnt from the labelled table gives each document a posterior over domains (quality x toxic). Document rates r,
no smaller than a floor, are fitted so that the expected tokens of each domain, the sum of posterior * tokens * rate, come
near their targets: the least sum of squared differences, each divided by the domain's tokens at rate 1, and of PULL times
the tokens-weighted squares of rate - 1, which chooses among rates that meet the targets alike.

Projected gradient rests where rate = max(floor, 1 - posterior . pull) for one vector over domains; Newton's steps on that
vector find it. A step is one aggregation over a small table: rates are never stored, shuffled or collected, and all
documents count in each step. Steps go on until the vector agrees with the tokens it gives.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, hash_words, keep, split_words, steps, table, text_or_empty, tidy

#: Domains by quality and toxic, in this order.
DOMAINS = ("low", "low_toxic", "high", "high_toxic")
#: Labelled rows the classifier is fitted on at most, those of the smallest hashes.
SAMPLE = 6000
BUCKETS, EXTRA = 2048, 8
#: Steps at most; the share of all tokens by which totals may be off where steps end; the weight of keeping rates at 1.
STEPS, TOLERANCE, PULL = 100, 1e-5, 1e-4
#: Rows whose features are held at once.
ROWS = 256
WEIGHTS = {"low": 0.15, "low_toxic": 0.0, "high": 0.85, "high_toxic": 0.0}


class Classifier(NamedTuple):
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: hashed words and eight shares of kinds of characters and words; and the number of words."""
    codes, offsets, vocabulary = split_words(texts, lower=True)
    n, size = len(texts), np.diff(offsets)
    bucket = (hash_words(vocabulary) % np.uint64(BUCKETS)).astype(np.int64)[codes]
    owner = np.repeat(np.arange(n), size)
    bag = np.log1p(np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)).astype(np.float32)
    bag /= np.maximum(np.linalg.norm(bag, axis=1, keepdims=True), 1e-6)
    more = np.zeros((n, EXTRA), np.float32)
    distinct = np.bincount(np.unique(owner * max(1, len(vocabulary)) + codes) // max(1, len(vocabulary)), minlength=n)[:n]
    for i, text in enumerate(texts.to_pylist()):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        all_ = max(1, len(raw))
        kinds = np.bincount(raw, minlength=256)
        upper, digits, lines = kinds[65:91].sum(), kinds[48:58].sum(), kinds[10]
        marks = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
        more[i, :5] = upper / all_, digits / all_, marks / all_, lines / all_, kinds[128:].sum() / all_
        more[i, 5] = np.log1p(size[i])
        more[i, 6] = distinct[i] / max(1, size[i])
        more[i, 7] = all_ / max(1, size[i])
    return np.c_[bag, more], size


def fit_classifier(x: np.ndarray, y: np.ndarray, rounds: int = 150, penalty: float = 1e-4) -> Classifier:
    """Softmax regression by full-batch gradient steps with momentum. Domains without examples keep a small share."""
    k = len(DOMAINS)
    centre, scale = np.zeros(x.shape[1], np.float32), np.ones(x.shape[1], np.float32)
    if len(x):
        centre[BUCKETS:] = x[:, BUCKETS:].mean(0)
        scale[BUCKETS:] = 1 / np.maximum(x[:, BUCKETS:].std(0), 1e-3)
    scale[:BUCKETS] = 4
    share = (np.bincount(y, minlength=k) + 0.5) / (len(y) + 0.5 * k)
    w = np.zeros((x.shape[1] + 1, k), np.float32)
    w[-1] = np.log(share)
    model = Classifier(w, centre, scale)
    if len(x):
        z = np.c_[(x - centre) * scale, np.ones(len(x), np.float32)]
        target, speed = np.eye(k, dtype=np.float32)[y], np.zeros_like(w)
        rate = 1.0 / max(1e-6, float((z * z).sum(1).mean()))
        for _ in range(rounds):
            grad = z.T @ (posterior_of(z @ w) - target) / len(z) + penalty * w * (np.arange(len(w)) < len(w) - 1)[:, None]
            speed = 0.9 * speed - 2 * rate * grad
            w += speed
    return model


def posterior_of(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def posteriors(model: Classifier, x: np.ndarray) -> np.ndarray:
    return posterior_of(((x - model.centre) * model.scale) @ model.weights[:-1] + model.weights[-1]).astype(np.float64)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """docs: id, text; labels: id, quality, toxic. Rows with other marks than 0 and 1 aren't used; of an id's rows the largest
    marks count, and of its texts the least. One task fits the model; its weights alone reach the driver."""
    marks = labels.where("id is not null and quality in (0, 1) and toxic in (0, 1)").groupBy("id").agg(
        F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic")
    )
    few = marks.withColumn("h", F.xxhash64("id", F.lit(4))).orderBy("h", "id").limit(sample)
    met = docs.join(F.broadcast(few), "id").select("id", "text", (2 * F.col("quality") + F.col("toxic")).alias("y"))  # `sample` rows at most
    rows = met.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y")).select("text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", rows=ROWS):
            x, _ = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([v.astype("<f4").tobytes() for v in x], pa.binary())], ["y", "x"])

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["y", "x"])
        x = np.frombuffer(b"".join(rows["x"]), "<f4").reshape(-1, BUCKETS + EXTRA)
        found = fit_classifier(x, rows["y"].to_numpy(np.int64))
        return pd.DataFrame({k: [v.astype("<f4").tobytes()] for k, v in found._asdict().items()})

    got = rows.mapInArrow(tidy(run), "y int, x binary").groupBy().applyInPandas(fitted, "weights binary, centre binary, scale binary").first()
    if got is None:
        return fit_classifier(np.zeros((0, BUCKETS + EXTRA), np.float32), np.zeros(0, np.int64))
    weights, centre, scale = (np.frombuffer(got[c], "<f4") for c in Classifier._fields)
    return Classifier(weights.reshape(-1, len(DOMAINS)), centre, scale)


def memberships(docs: DataFrame, model: Classifier) -> DataFrame:
    """docs: id, text, chance. Adds n_tokens (words) and p, the posterior; drops the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [docs.schema["id"], T.StructField("chance", T.DoubleType()), T.StructField("n_tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", rows=ROWS):
            x, size = features(batch.column("text"))
            p = posteriors(shared.value, x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)), pa.array(p.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("chance"), pa.array(size), lists], schema.fieldNames())

    return docs.select("id", "text", "chance").mapInArrow(tidy(run), schema)


def rate_column(pull: np.ndarray, floor: float) -> Column:
    """max(floor, 1 - posterior . pull)."""
    down = sum((F.col("p")[k] * F.lit(float(m)) for k, m in enumerate(pull)), F.lit(0.0))
    return F.greatest(F.lit(float(floor)), F.lit(1.0) - down)


def rates(pull: np.ndarray, p: np.ndarray, floor: float) -> np.ndarray:
    return np.maximum(float(floor), 1.0 - p @ pull)


def totals(members: DataFrame, pull: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Expected tokens by domain at the rates of a vector, minus their derivative by it, and the sum they are the slope of."""
    k, free = len(DOMAINS), F.col("rate") > floor
    of = [F.col("p")[i] * F.col("n_tokens") for i in range(k)]
    height = F.col("n_tokens") * F.when(free, F.col("rate") ** 2 / 2).otherwise(F.lit(floor) * F.col("plain") - F.lit(floor * floor / 2))
    rows = members.select("p", "n_tokens", rate_column(pull, floor).alias("rate"), rate_column(pull, -1e300).alias("plain"))
    got = rows.agg(
        *(F.sum(v * F.col("rate")) for v in of),
        *(F.sum(F.when(free, v * F.col("p")[j]).otherwise(0.0)) for v in of for j in range(k)),
        F.sum(height),
    ).first()
    sums = np.array([v or 0.0 for v in got])
    return sums[:k], sums[k:-1].reshape(k, k), float(sums[-1])


def solve(members: DataFrame, target: np.ndarray, plain: np.ndarray, floor: float, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vector at rest for these targets, from a first guess, by Newton's steps, halved where they lead up; the tokens reached."""
    hold = PULL * np.maximum(plain, 1e-9 * max(1.0, plain.sum()))
    height = lambda v, found: found[2] + target @ v + hold @ (v * v) / 2
    found = totals(members, pull, floor)
    for _ in range(STEPS):
        slope = target - found[0] + hold * pull
        if np.abs(slope).max() <= TOLERANCE * max(1.0, plain.sum()):
            break
        way, size = -np.linalg.solve(found[1] + np.diag(hold), slope), 1.0
        while True:
            next_ = totals(members, pull + size * way, floor)
            if height(pull + size * way, next_) <= height(pull, found) + 1e-4 * size * (slope @ way) or size < 1e-6:
                break
            size /= 2
        pull, found = pull + size * way, next_
    return pull, found[0]


def fit_rates(
    members: DataFrame, plain: np.ndarray, weights: dict[str, float], growth: float | None, floor: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The vector that gives the rates, and by domain the tokens at rate 1 (`plain`), wanted and reached. One row comes back a step.

    Without a growth it is the least at which no domain with a target has more tokens than its share of the mix; where
    repeated documents bring tokens of such a domain along, it rises until the shares are met or come no closer.
    Domains without a share then have the tokens that the least rate leaves them as their target, as no rates reach fewer.
    """
    floor = float(floor)
    share = np.array([weights[d] for d in DOMAINS], float)
    share /= share.sum()
    wanted = share > 0
    if not plain.sum():
        return np.zeros(len(share)), plain, plain, plain
    apart = np.where(wanted, 0.0, plain * floor)
    least = lambda tokens: share * float((tokens[wanted] / share[wanted]).max()) + apart
    off = lambda tokens: float(np.abs(tokens[wanted] / tokens[wanted].sum() - share[wanted]).max())
    target = least(plain * max(1.0, floor)) if growth is None else share * plain.sum() * growth
    pull, reached = solve(members, target, plain, floor, np.zeros(len(share)))
    while growth is None and off(reached) > 100 * TOLERANCE:
        higher = least(reached)
        more, found = solve(members, higher, plain, floor, pull)
        if off(found) > 0.9 * off(reached):
            break
        pull, target, reached = more, higher, found
    return pull, plain, target, reached


def _chance(id_: Column, text: Column) -> Column:
    """A number in [0, 1) from a row's id and text."""
    return F.xxhash64(id_, F.xxhash64(text)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))


class Mixture(NamedTuple):
    """What was fitted: the classifier, every row's posterior (id, chance, n_tokens, p), the vector that gives the rates, and by
    domain the tokens at rate 1, wanted, and reached."""

    model: Classifier
    members: DataFrame
    pull: np.ndarray
    plain: np.ndarray
    target: np.ndarray
    reached: np.ndarray

    def report(self) -> DataFrame:
        """domain, plain_tokens, target_tokens, reached_tokens: one row for each domain."""
        rows = [(d, *map(float, x)) for d, *x in zip(DOMAINS, self.plain, self.target, self.reached, strict=True)]
        return self.members.sparkSession.createDataFrame(rows, "domain string, plain_tokens double, target_tokens double, reached_tokens double")


def fit_mixture(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float] | None = None,
    growth: float | None = 1.0,
    floor: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Mixture:
    """The arguments are those of mix."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    model = learn(rows, labels.select(F.col(id_col).alias("id"), "quality", "toxic"))
    members = keep(memberships(rows.withColumn("chance", _chance(F.col("id"), F.col("text"))), model), "memberships")
    plain, _, _ = totals(members, np.zeros(len(DOMAINS)), 0.0)
    return Mixture(model, members, *fit_rates(members, plain, weights or WEIGHTS, growth, floor))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float] | None = None,
    growth: float | None = 1.0,
    floor: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_tokens, the posterior of each domain, rate, copies, and the shares that the mix was to have and
    has of each domain's tokens, the same in all rows.

    weights: share of each domain in the mix; growth: tokens of the mix for each token of the input, or None for
    as many as the shares need (see fit_rates); floor: the least rate. copies is the rate, rounded up or down by a number in
    [0, 1) from id and text, so that rows equal in both have as many.
    Null and empty texts have no tokens; their posteriors come from that. Rows that share an id have rates of their own. A
    null id is kept as it is. Without labels all posteriors are alike. Other columns aren't read, in docs or in labels. An
    empty table gives an empty result.
    """
    found = fit_mixture(docs, labels, weights, growth, floor, id_col, text_col)
    share = lambda v: v / max(v.sum(), 1e-300)
    rows = found.members.withColumn("rate", rate_column(found.pull, floor))
    return rows.select(
        F.col("id").alias(id_col),
        "n_tokens",
        *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)),
        "rate",
        F.floor(F.col("rate") + F.col("chance")).alias("copies"),
        *(F.lit(float(v)).alias(f"target_{d}") for d, v in zip(DOMAINS, share(found.target), strict=True)),
        *(F.lit(float(v)).alias(f"reached_{d}") for d, v in zip(DOMAINS, share(found.reached), strict=True)),
    )


def mixed_documents(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float] | None = None,
    growth: float | None = 1.0,
    floor: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of docs, each as often as mix says, with all their columns, whatever their names.

    Texts aren't shuffled: posteriors are worked out again. Null and empty texts have no tokens, and the rate that follows from
    their posterior. Rows equal in id and text come equally often, as do rows without ids that are equal in text. Without
    labels all rows have one rate. An empty table stays empty.
    """
    names, schema = docs.columns, docs.schema
    found = fit_mixture(docs, labels, weights, growth, floor, id_col, text_col)
    shared, pull = docs.sparkSession.sparkContext.broadcast(found.model), found.pull
    discard(found.members)
    text = text_or_empty(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", rows=ROWS):
            x, _ = features(batch.column("text"))
            copies = np.floor(rates(pull, posteriors(shared.value, x), floor) + batch.column("chance").to_numpy()).astype(np.int64)
            rows = np.repeat(np.arange(len(copies)), copies)
            whole = pa.RecordBatch.from_arrays(batch.column("row").flatten(), names)
            for at in range(0, len(rows), ROWS):
                yield whole.take(pa.array(rows[at : at + ROWS]))

    return docs.select(F.struct(*names).alias("row"), text.alias("text"), _chance(F.col(id_col), text).alias("chance")).mapInArrow(tidy(run), schema)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

"""A gated recurrent language model over words, with a class-factored softmax as its output, in numpy.

P(word | before) = P(class | state) * P(slot | class, state) * P(word | slot). The state comes from a gated recurrent network that
reads an embedding of each word's slot; the first two factors are softmaxes over it. Classes are by the kind of document a
word stands in, its number and its last character. The OWN most frequent words of a class have slots of their own, so their third
factor is 1; the rest of its words are dealt to its other slots by number, and share them by their counts. Rare words
share tail classes of one slot by the shape of the word, whose mass is spread by (count + 1) over their words and one unknown
word. So every word has a probability, and they sum to 1.

Training is truncated backpropagation through time over all words of all training documents, in windows that hand on their
state. Documents are dealt to shards of like size, whose number follows the corpus. One shard trains first; all others start
from its weights, train side by side, and their weights are averaged. Each word is trained on once, and more often only in a
corpus too small for LEAST updates. Scoring runs over whole documents: the state is carried from the first word to the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_remainder, discard, dropping_shuffles, give_back, hash_words, keep, mixed, most_frequent, split_words, steps, table, text_or_empty, tidy

#: Words known to every task at most (those of two or more occurrences, most frequent first); all others are counted too.
HEAD = 1 << 17
#: Kinds of documents, bins by number, and with two kinds of last characters, classes of several slots; slots of a class, and
#: how many of them hold one word.
KINDS, BINS = 6, 3
FULL, SLOTS, OWN = KINDS * BINS * 2, 32, 24
TAIL = 14
HIDDEN = 24
#: Steps that gradients run back, streams side by side, updates of a shard at least, and words of a shard, about.
BACK, STREAMS, LEAST, SHARD_WORDS = 16, 256, 150, 2_000_000
#: Centres of kinds are at rest when none of their numbers moves by more than this part of the largest.
REST = 1e-3
#: Numbers that stand for a text's letters, and what a share of 1 becomes as a whole number.
LETTERS, UNIT = 26 + 64, 65_535
#: Words scored side by side at most, and rows of one output product.
SCORED_WORDS, OUTPUT_ROWS = 2_000_000, 16_384
END = ""  # no word is empty
#: Numbers of slots: those of full classes, then END, then the tails, then the mark of a text's start, which is never a target.
END_SLOT, FIRST_TAIL, START = FULL * SLOTS, FULL * SLOTS + 1, FULL * SLOTS + 1 + TAIL


# --- the network ---------------------------------------------------------------------------------------------------

Weights = dict[str, np.ndarray]
#: Weights moved by Adam, every one at each update, and those moved by their own sums of squares (Adagrad).
DENSE, SPARSE = ("enter", "shift", "turn", "leave", "bias"), ("embed", "inner", "tilt")


def initial(classes: np.ndarray, slots: np.ndarray, hidden: int = HIDDEN, seed: int = 1) -> Weights:
    """Weights that predict the counts of classes, and of slots in each full class (0: no such slot). Classes after the full ones
    have one slot."""
    rng, full = np.random.default_rng(seed), slots.size
    small = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    inside = np.where(slots > 0, np.log(np.maximum(slots, 1e-30)), -1e30)
    return {
        "embed": small(0.3, full + len(classes) - len(slots) + 1, hidden),
        "enter": small(0.4, hidden, 3 * hidden),
        "shift": np.zeros(3 * hidden, np.float32),
        "turn": small(0.2, hidden, 3 * hidden),
        "leave": small(0.1, hidden, len(classes)),
        "bias": np.log(classes / classes.sum()).astype(np.float32),
        "inner": small(0.05, len(slots), hidden, slots.shape[1]),
        "tilt": inside.astype(np.float32),
    }


def step(w: Weights, entered: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of all streams, h = z * h + (1 - z) * n: the state, z, r, n, and what n took from the state."""
    k = h.shape[1]
    u = h @ w["turn"]
    gates = entered[:, : 2 * k] + u[:, : 2 * k]
    np.negative(gates, out=gates)
    np.exp(np.minimum(gates, 60, out=gates), out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    z, r, held = gates[:, :k], gates[:, k:], u[:, 2 * k :]
    n = np.tanh(entered[:, 2 * k :] + r * held)
    return n + z * (h - n), z, r, n, held


def _picked(logits: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of columns of logits, which become exponentials in place: the log probability of each target, and the column's sum."""
    logits -= logits.max(0, initial=-1e30)
    out = logits[target, np.arange(logits.shape[1])].astype(np.float64)
    np.exp(logits, out=logits)
    total = logits.sum(0)
    return out - np.log(total), total


def outputs(w: Weights, states: np.ndarray, target: np.ndarray, learn: bool = False) -> tuple[np.ndarray, Weights, np.ndarray]:
    """The log probability of each target slot; to learn, gradients of the mean loss by the output weights and by the states.

    Rows are put in order of their classes, so that each class is one product; columns of products are rows.
    """
    inner, tilt = w["inner"], w["tilt"]
    many, _, wide = inner.shape
    klass = np.where(target < many * wide, target // wide, target - many * wide + many)
    order = np.argsort(klass.astype(np.uint8), kind="stable")
    klass = klass[order]
    cut = np.searchsorted(klass, np.arange(many + 1)).tolist()
    inside = cut[-1]
    h = np.ascontiguousarray(states[order].T)
    p = w["leave"].T @ h
    p += w["bias"][:, None]
    logs, total = _picked(p, klass)
    q = np.empty((wide, inside), states.dtype)
    parts = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
    for c, at in parts:
        q[:, at] = inner[c].T @ h[:, at]
        q[:, at] += tilt[c][:, None]
    slot = target[order[:inside]] % wide
    more, whole = _picked(q, slot)
    logs[:inside] += more
    out = np.empty(len(logs))
    out[order] = logs
    if not learn:
        return out, {}, states
    n = len(out)
    p /= total * n
    p[klass, np.arange(n)] -= 1 / n
    q /= whole * n
    q[slot, np.arange(inside)] -= 1 / n
    down = w["leave"] @ p
    grad = {"leave": h @ p.T, "bias": p.sum(1), "inner": np.zeros_like(inner), "tilt": np.zeros_like(tilt)}
    for c, at in parts:
        grad["inner"][c] = h[:, at] @ q[:, at].T
        grad["tilt"][c] = q[:, at].sum(1)
        down[:, at] += inner[c] @ q[:, at]
    back = np.empty_like(states)
    back[order] = down.T
    return out, grad, back


def gradients(w: Weights, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray, float]:
    """Truncated backpropagation over one window of all streams: gradients, the state after it, the loss per word.

    x, y: slots read and to be told, by step and stream; fresh: where a document begins, and the state is empty. The gradient
    of the embedding is (slots that were read, their rows).
    """
    (size, streams), k = x.shape, h.shape[1]
    read = w["embed"][x].reshape(-1, k)
    entered = (read @ w["enter"] + w["shift"]).reshape(size, streams, 3 * k)
    before, states, z, r, n, held = (np.empty((size, streams, k), h.dtype) for _ in range(6))
    starts, going = fresh.any(1).tolist(), (~fresh)[:, :, None].astype(h.dtype)
    for t in range(size):
        before[t] = h * going[t] if starts[t] else h
        h, z[t], r[t], n[t], held[t] = step(w, entered[t], before[t])
        states[t] = h
    logs, grad, down = outputs(w, states.reshape(-1, k), y.reshape(-1), True)
    down = down.reshape(size, streams, k)
    by_n, by_z, by_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), held * r * (1 - r)
    back = np.ascontiguousarray(w["turn"].T)
    du, dn, after = np.empty((size, streams, 3 * k), h.dtype), np.empty_like(z), np.zeros_like(h)
    for t in range(size - 1, -1, -1):
        d = down[t] + after
        np.multiply(d, by_n[t], out=dn[t])
        np.multiply(d, by_z[t], out=du[t, :, :k])
        np.multiply(dn[t], by_r[t], out=du[t, :, k : 2 * k])
        np.multiply(dn[t], r[t], out=du[t, :, 2 * k :])
        after = d * z[t] + du[t] @ back
        if starts[t]:
            after *= going[t]
    grad["turn"] = before.reshape(-1, k).T @ du.reshape(-1, 3 * k)
    du[:, :, 2 * k :] = dn
    du = du.reshape(-1, 3 * k)
    grad["enter"], grad["shift"] = read.T @ du, du.sum(0)
    slots = x.reshape(-1)
    order = np.argsort(slots.astype(np.uint16), kind="stable")
    slots = slots[order]
    first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
    grad["embed"] = slots[first], np.add.reduceat((du @ w["enter"].T)[order], first)
    return grad, h, float(-logs.mean())


def train_shard(w: Weights, codes: list[np.ndarray], least: int = LEAST, seed: int = 0, rate: float = 0.01, pace: float = 0.1) -> Weights:
    """Streams of documents, in an order drawn by seed; the state is carried from window to window. A shard makes as many
    updates as all its words fill, and passes over its documents again where that is less than `least`, or to fill the last
    window. codes: of each document its slots, led by START."""
    rng = np.random.default_rng(seed)
    w = {k: v.copy() for k, v in w.items()}
    one, two = ({k: np.zeros_like(w[k]) for k in DENSE} for _ in range(2))
    seen = {k: np.full_like(w[k], 1e-8) for k in SPARSE}
    updates = max(least, ceil(sum(len(c) - 1 for c in codes) / (BACK * STREAMS)))
    need, parts, starts, total = updates * BACK * STREAMS, [], [], 0
    while total < need:
        for i in rng.permutation(len(codes)):
            parts.append(codes[i])
            starts.append(total)
            total += len(codes[i]) - 1
            if total >= need:
                break
    x = np.concatenate([c[:-1] for c in parts])[:need].reshape(STREAMS, -1)
    y = np.concatenate([c[1:] for c in parts])[:need].reshape(STREAMS, -1)
    del parts
    fresh = np.zeros(need, bool)
    fresh[[s for s in starts if s < need]] = True
    fresh = fresh.reshape(STREAMS, -1)
    fresh[:, 0] = True
    h = np.zeros((STREAMS, w["turn"].shape[0]), np.float32)
    for i in range(updates):
        at = slice(i * BACK, (i + 1) * BACK)
        turned = (np.ascontiguousarray(v[:, at].T) for v in (x, y, fresh))
        grad, h, _ = gradients(w, *turned, h)
        left = 1 - 0.8 * i / updates
        for k in DENSE:
            g = grad[k]
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.99 * two[k] + 0.01 * g * g
            m, v = one[k] / (1 - 0.9 ** (i + 1)), two[k] / (1 - 0.99 ** (i + 1))
            w[k] -= (rate * left * m / (np.sqrt(v) + 1e-6)).astype(np.float32)
        for k in SPARSE:
            rows, g = grad[k] if k == "embed" else (slice(None), grad[k])
            sums = seen[k][rows] + g * g
            seen[k][rows] = sums
            w[k][rows] -= pace * left * g / np.sqrt(sums)
    return w


def log_likelihoods(w: Weights, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The natural log probability of each text's slots, from its first to its last.

    Texts run side by side, longest first, so that those still running at a step stand in front; none is cut.
    """
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    size, first = size[order], bounds[:-1][order]
    sums = np.zeros(len(order))
    h = np.zeros((len(order), w["turn"].shape[0]), w["turn"].dtype)
    running = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")  # texts of more than t words
    states, targets = [], []

    def settle() -> None:
        found, _, _ = outputs(w, np.concatenate(states), np.concatenate(targets))
        at = 0
        for s in states:
            sums[: len(s)] += found[at : at + len(s)]
            at += len(s)
        states.clear()
        targets.clear()

    table = w["embed"] @ w["enter"] + w["shift"]
    x, waiting = np.full(len(order), len(table) - 1), 0
    for t, n in enumerate(running.tolist()):
        h = step(w, table[x[:n]], h[:n])[0]
        x = codes[first[:n] + t]
        states.append(h)
        targets.append(x)
        waiting += n
        if waiting >= OUTPUT_ROWS:
            settle()
            waiting = 0
    if states:
        settle()
    out = np.empty(len(order))
    out[order] = sums
    return out


# --- counts and classes --------------------------------------------------------------------------------------------


def letters(texts: pa.Array) -> np.ndarray:
    """How often letters and bytes beyond ASCII stand in each text, as square roots of shares."""
    out = np.zeros((len(texts), LETTERS))
    for i, text in enumerate(texts.to_pylist()):
        n = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        out[i, :26], out[i, 26:] = n[65:91] + n[97:123], n[128:192]
    return np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1))


def _drawn(x: np.ndarray, centres: np.ndarray, factors: np.ndarray) -> tuple[float, bytes]:
    """The least of exponential numbers, one for each point, at the rate of its squared distance from the centres, and that point's
    bytes. What is random comes from a hash of the point, so no order matters. Points on a centre are at infinity."""
    if not len(x):
        return np.inf, b""
    far = (x * x).sum(1) + (-2 * x @ centres.T + (centres**2).sum(1)).min(1) if len(centres) else np.ones(len(x))
    bits = np.ascontiguousarray(x).view(np.uint64)
    with np.errstate(over="ignore"):
        h = mixed(((bits ^ (bits >> np.uint64(32))) * factors).sum(1))
    with np.errstate(divide="ignore"):
        key = np.where(far > 0, -np.log((h + 0.5) / 2.0**64) / np.maximum(far, 0), np.inf)
    best = key.argmin()
    return float(key[best]), x[best].tobytes()


def _sums(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of each centre: sums over the points nearest to it, and their number."""
    own = kind_of(centres, x)[:, None] == np.arange(len(centres))
    return np.c_[own.T.astype(float) @ x, own.sum(0)]


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), "<u2").reshape(-1, LETTERS).astype(float)


def _drawn_of_all(rows: DataFrame, centres: np.ndarray, factors: np.ndarray) -> tuple[float, bytes]:
    """_drawn over a table of points; a row of each task is compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, x = min((_drawn(_points(b), centres, factors) for b in batches), default=(np.inf, b""))
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([x])], ["key", "x"])

    found = rows.mapInArrow(tidy(run), "key double, x binary").orderBy("key", "x").first()
    return (found["key"], bytes(found["x"])) if found else (np.inf, b"")


def _sums_of_all(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """_sums over a table of points, which are whole numbers: sums are exact however rows are dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), LETTERS + 1))
        for batch in batches:
            total += _sums(_points(batch), centres)
        flat = total.astype(np.int64).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["at", "s"])

    out = np.zeros(len(centres) * (LETTERS + 1))
    with dropping_shuffles(rows.sparkSession):
        for r in rows.mapInArrow(tidy(run), "at int, s long").groupBy("at").agg(F.sum("s").alias("s")).collect():  # one row per number
            out[r["at"]] = r["s"]
    return out.reshape(len(centres), -1)


def fit_kinds(x: np.ndarray | DataFrame, kinds: int, seed: int = 0) -> np.ndarray:
    """Centres of k-means over all points, of an array or of a table that `described` made, started far from each other; fewer
    than `kinds` where fewer points differ. Of a table only one point, or a sum for each centre, reaches the driver a pass."""
    draw, add = (_drawn, _sums) if isinstance(x, np.ndarray) else (_drawn_of_all, _sums_of_all)
    factors = np.random.default_rng(seed).integers(0, 1 << 64, (kinds, LETTERS), np.uint64) | np.uint64(1)
    centres = np.zeros((0, LETTERS))
    for k in range(kinds):
        key, found = draw(x, centres, factors[k])
        if key == np.inf:
            break
        centres = np.r_[centres, np.frombuffer(found)[None]]
    if not len(centres):
        return np.zeros((1, LETTERS))
    while True:  # the squares of distances shrink with each pass, so this ends
        total = add(x, centres)
        before, centres = centres, np.where(total[:, -1:] > 0, total[:, :-1] / np.maximum(total[:, -1:], 1), centres)
        if np.abs(centres - before).max() <= REST * np.abs(centres).max():
            return centres


def described(docs: DataFrame) -> DataFrame:
    """Each text's letters, in whole numbers of UNIT. docs: text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            x = np.rint(letters(batch.column("text")) * UNIT).astype("<u2")
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary())], ["x"])

    return docs.mapInArrow(tidy(run), "x binary")


def kind_of(centres: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (-2 * x @ centres.T + (centres**2).sum(1)).argmin(1)


def shapes(words: pa.Array) -> np.ndarray:
    """The tail class of each word: by its first character beyond ASCII, if any, and whether it ends in a letter or digit."""
    out = pc.utf8_is_alnum(pc.utf8_slice_codeunits(words, -1)).to_numpy(zero_copy_only=False).astype(np.int64)
    beyond = np.flatnonzero(~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))
    for i, w in zip(beyond.tolist(), words.take(pa.array(beyond)).to_pylist(), strict=True):
        out[i] += 2 + 2 * (ord(next(c for c in w if not c.isascii())) % 6)
    return out


class Model(NamedTuple):
    """known: sorted hashes of the head words, END among them; of_code: of each its slot, its log10 P(word | slot), its
    log10(count + 1), its count; tail: log10 of the norm of each tail class."""

    known: np.ndarray
    of_code: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    tail: np.ndarray
    total: int
    distinct: int
    weights: Weights


class _Coded(NamedTuple):
    offsets: np.ndarray
    slots: np.ndarray
    inside: np.ndarray
    base: np.ndarray
    counted: np.ndarray
    tail_codes: np.ndarray
    hashes: np.ndarray


def _coded(model: Model, texts: pa.Array) -> _Coded:
    """By word: its slot, log10 P(word | slot) but for a tail word's count, log10(count + 1) and whether it's counted (head
    words), and for tail words the place of its hash, else -1. Each text ends in END."""
    codes, offsets, vocabulary = split_words(texts, lower=True)
    words = pa.concat_arrays([vocabulary.cast(pa.string()), pa.array([END], pa.string())])
    names = hash_words(words)
    code = np.minimum(np.searchsorted(model.known, names), len(model.known) - 1)
    tail = np.flatnonzero(model.known[code] != names)
    slot, inside, base, n = (a[code] for a in model.of_code)
    shape = shapes(words.take(pa.array(tail)))
    slot[tail], inside[tail], base[tail], n[tail] = FIRST_TAIL + shape, -model.tail[shape], 0, 0
    place = np.full(len(words), -1)
    place[tail] = np.arange(len(tail))
    hashes = names[tail]
    ends = offsets[1:] + np.arange(len(offsets) - 1)
    flat = np.empty(len(codes) + len(offsets) - 1, np.int64)
    mask = np.ones(len(flat), bool)
    mask[ends] = False
    flat[mask], flat[ends] = codes, len(words) - 1
    return _Coded(np.r_[0, ends + 1], slot[flat], inside[flat], base[flat], n[flat] > 0, place[flat], hashes)


def count_words(docs: DataFrame, centres: np.ndarray) -> DataFrame:
    """word, h (its hash), n, and n by kind of document; END counts once a document. docs: text."""
    shared = docs.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            texts = batch.column("text")
            codes, offsets, vocabulary = split_words(texts, lower=True)
            kind = kind_of(shared.value, letters(texts))
            size = len(vocabulary)
            key, n = np.unique(np.repeat(kind, np.diff(offsets)) * size + codes, return_counts=True) if size else (codes, codes)
            code = key % max(size, 1)
            ends, m = np.unique(kind, return_counts=True)
            words = pa.concat_arrays([vocabulary.take(pa.array(code)), pa.array([END] * len(ends), pa.string())])
            hashes = hash_words(vocabulary)[code].view(np.int64)
            hashes = np.r_[hashes, hash_words(pa.array([END])).view(np.int64).repeat(len(ends))]
            kinds = np.r_[key // max(size, 1), ends]
            yield pa.RecordBatch.from_arrays(
                [words, pa.array(hashes), pa.array(kinds.astype(np.int32)), pa.array(np.r_[n, m].astype(np.int64))], ["word", "h", "kind", "n"]
            )

    rows = docs.mapInArrow(tidy(run), "word string, h long, kind int, n long")
    by_kind = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(KINDS)]
    return rows.groupBy("word", "h").agg(F.sum("n").alias("n"), *by_kind)


def slots_of(words: list[str], n: np.ndarray, by_kind: np.ndarray) -> np.ndarray:
    """The slot of each word but END, which has its own; words come most frequent first. by_kind: their counts by kind of document."""
    kind = ((by_kind + 0.1) / (by_kind.sum(0) + 1)).argmax(1)
    mass = np.cumsum(np.sqrt(n + 1.0))
    bin_ = np.minimum(mass * BINS / (mass[-1] + 1), BINS - 1).astype(int) if len(mass) else mass.astype(int)
    klass = (kind * BINS + bin_) * 2 + np.fromiter((w[-1:].isalnum() for w in words), bool, len(words))
    slot = np.zeros(len(words), np.int64)
    for c in range(FULL):
        own = np.flatnonzero(klass == c)
        held = np.cumsum(n[own][OWN:] + 1.0)
        shared = OWN + np.minimum(held * (SLOTS - OWN) / (held[-1] + 1), SLOTS - OWN - 1).astype(int) if len(held) else []
        slot[own] = c * SLOTS + np.concatenate([np.arange(min(OWN, len(own))), shared]).astype(np.int64)
    slot[[i for i, w in enumerate(words) if w == END]] = END_SLOT
    return slot


def build(counts: DataFrame, head: int = HEAD) -> Model:
    """Slots and the probabilities within them. Only the head, of bounded size, and sums by tail class reach the driver."""
    often = most_frequent(counts.where("n > 1 and word <> ''"), "n", head - 1)
    top = often.union(counts.where("word = ''")).toPandas().sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = total or 0, distinct
    if not (top["word"] == END).any():
        top = pd.concat([top, pd.DataFrame([{"word": END, "n": 0} | {f"n{k}": 0 for k in range(KINDS)}])], ignore_index=True)
    words, n = top["word"].tolist(), top["n"].to_numpy(np.int64)
    slot = slots_of(words, n, top[[f"n{k}" for k in range(KINDS)]].to_numpy(float))
    sums = np.bincount(slot, np.maximum(n, 1), START)
    inside = np.log10(np.maximum(n, 1) / sums[slot])
    hashes = hash_words(pa.array(words, pa.string()))
    order = np.argsort(hashes)
    known = hashes[order]

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = heads.value
        for batch in batches:
            names = batch.column("h").to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(head[np.minimum(np.searchsorted(head, names), len(head) - 1)] != names))
            shape = shapes(batch.column("word"))
            held, times = np.bincount(shape, minlength=TAIL), np.bincount(shape, batch.column("n").to_numpy(), TAIL)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(TAIL, dtype=np.int32)), pa.array(held.astype(np.int64)), pa.array(times.astype(np.int64))], ["shape", "v", "n"]
            )

    heads = counts.sparkSession.sparkContext.broadcast(known)
    rare = counts.select("word", "h", "n").mapInArrow(tidy(tails), "shape int, v long, n long").groupBy("shape").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    norm = np.ones(TAIL)
    for r in rare.collect():  # one row per tail class
        norm[r["shape"]], sums[FIRST_TAIL + r["shape"]] = r["n"] + r["v"] + 1, r["n"]
    heads.destroy()
    slots = sums[:END_SLOT].reshape(FULL, SLOTS)
    classes = np.r_[np.where(slots.sum(1) > 0, slots.sum(1) + 0.5, 1e-30), sums[END_SLOT:] + 0.5]
    table = tuple(x[order] for x in (slot, inside, np.log10(n + 1.0), n))
    return Model(known, table, np.log10(norm), int(total), int(distinct), initial(classes, slots))


_CODED = T.StructType(
    [
        T.StructField("held_out", T.BooleanType()),
        T.StructField("row", T.LongType()),
        *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_head")),
        *(T.StructField(c, T.DoubleType()) for c in ("base", "inside")),
        T.StructField("codes", T.BinaryType()),
        T.StructField("tail", T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("k", T.IntegerType())]))),
    ]
)


def coded_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Texts become numbers once, for training and for scoring. docs: id, held_out, text. codes: of each document all its
    slots, as little-endian 16-bit integers; row: a number of its own; tail: hashes of its tail words and how often they come."""
    shared = docs.sparkSession.sparkContext.broadcast(model._replace(weights={}))
    schema = T.StructType([docs.schema["id"], *_CODED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in steps(batches, "text"):
            c = _coded(shared.value, batch.column("text"))
            size, begins = np.diff(c.offsets), c.offsets[:-1]
            owner = np.repeat(np.arange(len(size)), size)
            rare = np.flatnonzero(c.tail_codes >= 0)
            many = max(1, len(c.hashes))
            pair, k = np.unique(owner[rare] * many + c.tail_codes[rare], return_counts=True)
            found = pa.StructArray.from_arrays(
                [pa.array(c.hashes[pair % many].view(np.int64) if len(pair) else np.empty(0, np.int64)), pa.array(k.astype(np.int32))], ["h", "k"]
            )
            tails = pa.ListArray.from_arrays(pa.array(np.searchsorted(pair // many, np.arange(len(size) + 1)).astype(np.int32)), found)
            add = lambda v, begins=begins: pa.array(np.add.reduceat(v, begins))
            packed, at = c.slots.astype("<u2").tobytes(), (2 * c.offsets).tolist()
            codes = pa.array([packed[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            numbers = pa.array(np.arange(row, row + len(size)))
            row += len(size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), numbers, pa.array(size), add(c.counted.astype(np.int64)), add(c.base), add(c.inside), codes, tails],
                schema.fieldNames(),
            )

    return docs.mapInArrow(tidy(run), schema)


def unpacked(codes: bytes) -> np.ndarray:
    return np.frombuffer(codes, "<u2").astype(np.int32)


def _trainer(weights: Weights, meets: int):
    """Trains one shard; its weights come back as one row of float32 bytes, in order of their names."""
    names = sorted(weights)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        start = np.array([START], np.int32)
        codes = [np.concatenate([start, unpacked(c)]) for c in rows.sort_values(["draw", "codes"])["codes"]]
        w = train_shard(weights, codes, LEAST, key[0])
        del codes, rows
        give_back()
        return pd.DataFrame({"meet": [key[0] % meets], "n": [1], "w": [np.concatenate([w[k].reshape(-1) for k in names]).astype("<f4").tobytes()]})

    return run


def _summed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of weights, and the number of shards in them."""
    total = np.zeros(len(rows["w"].iloc[0]) // 4)
    for w in rows["w"]:
        total += np.frombuffer(w, "<f4")
    return pd.DataFrame({"meet": [0], "n": [int(rows["n"].sum())], "w": [total.astype("<f4").tobytes()]})


def fit(coded: DataFrame, model: Model) -> Model:
    """coded: id, codes, of the documents to learn from. The first shard trains alone, then all others from its weights. Sums of
    weights meet on the executors, in as many tasks as the root of the number of shards; one row reaches the driver a round."""
    size = coded.agg(F.sum(F.length("codes") / 2)).first()[0] or 0
    if not size:
        return model
    shards = max(1, round(size / SHARD_WORDS))
    meets = max(1, round(shards**0.5))
    # A null id, and rows that share an id, are told apart by their codes.
    dealt = coded.select(F.xxhash64("id", F.lit(3)).alias("draw"), "codes").withColumn("shard", F.pmod(F.xxhash64("draw", "codes"), F.lit(shards)).cast("int"))
    weights = model.weights
    kind = "meet int, n int, w binary"
    for part in ("shard = 0", "shard > 0")[: 2 if shards > 1 else 1]:
        trained = dealt.where(part).groupBy("shard").applyInPandas(_trainer(weights, meets), kind)
        got = trained.groupBy("meet").applyInPandas(_summed, kind).groupBy("meet").applyInPandas(_summed, kind).first()
        if got is None:  # no document fell into this part
            continue
        flat, at = np.frombuffer(got.w, "<f4") / got.n, 0
        fresh = {}
        for k in sorted(weights):
            fresh[k] = flat[at : at + weights[k].size].reshape(weights[k].shape).astype(np.float32)
            at += weights[k].size
        weights = fresh
    return model._replace(weights=weights)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(id as text) mod `folds` isn't `held`. Null texts count as empty and hold the end alone;
    a null id counts as empty text. Rows that share an id are scored, and counted, each on its own. Other columns aren't
    read. With nothing to learn from, every count is 0. An empty table gives an empty result. Words outside the head are
    matched with their counts by a 64-bit hash.
    """
    part = crc_remainder(id_col, folds)
    docs = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), (part == held).alias("held_out"))
    train = docs.where("not held_out")
    points = keep(described(train.select("text")), "letters")
    centres = fit_kinds(points, KINDS) / UNIT
    discard(points)
    counts = keep(count_words(train.select("text"), centres), "counts")
    model = build(counts)
    coded = keep(coded_documents(docs, model), "coded")
    weights = fit(coded.where("not held_out").select("id", "codes"), model).weights
    schema = T.StructType([*coded.drop("codes", "tail").schema.fields, T.StructField("found", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def settle() -> Iterator[pa.RecordBatch]:
            if waiting:
                codes = [c for b in waiting for c in b.column("codes").to_pylist()]
                bounds = np.concatenate([[0], np.cumsum([len(c) // 2 for c in codes])])
                found = log_likelihoods(weights, unpacked(b"".join(codes)), bounds) / np.log(10)
                at = 0
                for b in waiting:
                    yield pa.RecordBatch.from_arrays([*(b.column(c) for c in schema.fieldNames()[:-1]), pa.array(found[at : at + b.num_rows])], schema.fieldNames())
                    at += b.num_rows
                waiting.clear()

        words = 0
        for batch in batches:
            for b in steps([batch], "codes", 2 * SCORED_WORDS):
                waiting.append(b)
                words += int(np.sum(b.column("n_tokens").to_numpy()))
                if words >= SCORED_WORDS:
                    yield from settle()
                    words = 0
        yield from settle()

    rows = coded.drop("tail").mapInArrow(tidy(run), schema)
    rare = coded.select("row", F.inline("tail")).join(counts.select("h", "n"), "h")
    more = rare.groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more"), F.sum("k").alias("n_tail"))
    extra = F.coalesce("more", F.lit(0.0))
    norm = float(np.log10(model.total + model.distinct + 1))
    return rows.join(more, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("found") + F.col("inside") + extra).alias("score"),
    )


def op3_recurrent_lm(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))

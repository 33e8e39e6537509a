"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and goes to all tasks; every row is indexed under one leaf. The more rows, the larger the
sample and the smaller a leaf's part of it, so that leaves grow with the root of the number of rows until the sample's bound. A query walks the tree with
a priority queue, nearest centre first, and visits leaves in that order. How many it visits is calibrated: for some vectors
the true neighbours among all rows are found, and visits are widened until the leaves met hold the share asked for. Rows and
queries then meet in blocks of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keep, table, tidy

#: Vectors the tree is fitted on: so many at least, so many for each root of a row, and so many numbers at most.
SAMPLE, SAMPLE_BY_ROOT, SAMPLE_NUMBERS = 20_000, 20, 8_000_000
#: Vectors of the sample in a leaf at least and at most, and branches of a node.
LEAST_LEAF, LEAF, BRANCHES = 5, 50, 8
#: Vectors that visits are calibrated on at most, and the share of their neighbours to be met.
CALIBRATION, RECALL = 200, 0.98
#: Groups of leaves, and rows and queries of a block at most, about.
GROUPS, BLOCK_ROWS, BLOCK_QUERIES = 64, 20_000, 4_000


class Tree(NamedTuple):
    """centres: one per node; children: of each node, none for a leaf; leaf: number of a leaf or -1. Node 0 is the root."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray
    n_leaves: int


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _split(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means: the cluster of each row."""
    centres = x[rng.choice(len(x), k, replace=False)]
    own = np.zeros(len(x), np.int64)
    for _ in range(12):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        fresh = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-12, sums, centres)
        centres = _unit(fresh)
    return own


def fit(x: np.ndarray, leaf: int = LEAF, branches: int = BRANCHES, seed: int = 0) -> Tree:
    """x: unit vectors. A set that can't be split, such as copies of one vector, is a leaf whatever its size."""
    rng = np.random.default_rng(seed)
    centres, children, leaves, n = [_unit(x.mean(0, keepdims=True))[0] if len(x) else np.zeros(1)], [[]], [-1], 0
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        parts = []
        if len(rows) > leaf:
            own = _split(x[rows], min(branches, len(rows)), rng)
            parts = [rows[own == k] for k in np.unique(own)]
        if len(parts) < 2:
            leaves[node], n = n, n + 1
            continue
        for part in parts:
            children[node].append(len(centres))
            centres.append(_unit(x[part].mean(0, keepdims=True))[0])
            children.append([])
            leaves.append(-1)
            todo.append((len(centres) - 1, part))
    return Tree(np.array(centres), children, np.array(leaves), n)


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each unit vector: at each node, the nearest child."""
    out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if tree.leaf[node] >= 0:
            out[rows] = tree.leaf[node]
            continue
        kids = tree.children[node]
        # einsum gives equal vectors equal sums, wherever they stand in a batch; so copies share a leaf.
        own = np.einsum("ij,kj->ik", x[rows], tree.centres[kids]).argmax(1)
        todo += [(kid, rows[own == k]) for k, kid in enumerate(kids) if (own == k).any()]
    return out


def visits(tree: Tree, q: np.ndarray, least: int, held: np.ndarray | None = None, rows: int = 0) -> list[int]:
    """The leaves in the order in which a best-bin-first walk meets them: `least` of them, and on until they hold `rows` rows."""
    near = tree.centres @ q
    queue, out, got = [(-near[0], 0)], [], 0
    while queue and (len(out) < least or got < rows):
        _, node = heapq.heappop(queue)
        if tree.leaf[node] >= 0:
            out.append(int(tree.leaf[node]))
            got += int(held[out[-1]]) if held is not None else 0
        for kid in tree.children[node]:
            heapq.heappush(queue, (-near[kid], kid))
    return out


def _usable(column: str, width: int | None = None) -> Column:
    """Vectors with components that are all finite numbers, not all zero, and as many as `width`."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ok = F.col(column).isNotNull() & (F.size(column) > 0) & F.coalesce(good, F.lit(False)) & F.exists(column, lambda x: x != 0)
    return ok & (F.size(column) == width) if width else ok


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def top(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, seen: np.ndarray | None = None) -> Iterator:
    """For each query its k nearest rows by cosine, ties to smaller ids: (its number, their places, their scores). The row
    with the query's own id takes no part, nor do rows where seen[query, row] is false."""
    norms, wide = _norms(x), _norms(queries)
    for at in range(0, len(queries), 128):
        part = slice(at, at + 128)
        rough = (queries[part] @ x.T) / (wide[part, None] * norms[None, :])
        rough[query_ids[part, None] == ids[None, :]] = -np.inf
        if seen is not None:
            rough[~seen[part]] = -np.inf
        cut = min(k, rough.shape[1])
        bound = np.partition(rough, rough.shape[1] - cut, axis=1)[:, rough.shape[1] - cut] - 1e-9
        for i in range(len(rough)):
            place = np.flatnonzero((rough[i] >= bound[i]) & np.isfinite(rough[i]))
            # Whatever order a matrix product adds in, equal vectors get equal scores here.
            exact = np.einsum("ij,j->i", x[place], queries[at + i]) / (norms[place] * wide[at + i])
            order = np.lexsort((ids[place], -exact))[:k]
            yield at + i, place[order], exact[order]


def _nearest_in_all(rows: DataFrame, queries: np.ndarray, query_ids: np.ndarray, k: int, width: int) -> pd.DataFrame:
    """The true neighbours of a bounded number of queries: query, vec_id, score."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, query_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, qid = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _matrix(batch.column("vec"), width), batch.column("id").to_numpy()
            found = [(n, ids[p], s) for n, p, s in top(q, qid, x, ids, k)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(len(p), n) for n, p, _ in found]).astype(np.int64)),
                    pa.array(np.concatenate([p for _, p, _ in found]).astype(np.int64)),
                    pa.array(np.concatenate([s for _, _, s in found]).astype(np.float64)),
                ],
                ["query", "id", "score"],
            )

    near = rows.mapInArrow(tidy(run), "query long, id long, score double")
    nth = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))
    return near.withColumn("nth", nth).where(F.col("nth") <= k).toPandas()  # k rows for each of the few queries


def calibrated(tree: Tree, rows: DataFrame, sample: np.ndarray, sample_ids: np.ndarray, k: int, recall: float, width: int) -> int:
    """How many leaves a walk must visit to meet `recall` of the true neighbours of the calibration vectors."""
    true = _nearest_in_all(rows, sample, sample_ids, k, width)
    if not len(true):
        return tree.n_leaves
    vectors = rows.join(F.broadcast(rows.sparkSession.createDataFrame(true[["id"]].drop_duplicates())), "id").select("id", "vec")
    known = _packed(vectors.dropDuplicates(["id"]))
    leaf = dict(zip(known["id"], assign(tree, _unit(_rows_of(known["vec"], width))), strict=True))
    ranks = []
    for n, group in true.groupby("query"):
        order = visits(tree, _unit(sample[n : n + 1])[0], tree.n_leaves)
        place = {x: i + 1 for i, x in enumerate(order)}
        ranks += [place[leaf[i]] for i in group["id"]]
    return int(np.sort(ranks)[ceil(recall * len(ranks)) - 1])


def _packed(rows: DataFrame) -> pd.DataFrame:
    """id, vec as bytes of numbers: arrays of a sample never become lists in the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v.values, np.float64).tobytes() for v in batch.column("vec")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(vectors, pa.binary())], ["id", "vec"])

    return rows.select("id", "vec").mapInArrow(tidy(run), "id long, vec binary").toPandas()


def _rows_of(packed: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(-1, width)


def search(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    recall: float = RECALL,
    sample: int = SAMPLE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), id, score: the nearest rows found for each query, but for those with the query's id.

    Vectors that are null, zero, hold null or non-finite components, or have another length than most rows, take no
    part; nor do rows or queries with null ids. Equal scores go to smaller ids. Rows that share an id are rows of their own.
    Queries with fewer than k candidates get them all; empty tables give an empty result. Other columns aren't read.
    """
    spark = rows.sparkSession

    def plain(df: DataFrame, width: int | None = None) -> DataFrame:
        found = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
        return found.where(F.col("id").isNotNull() & _usable("vec", width))

    known = plain(rows)
    schema = "query_id long, rank int, vec_id long, score double"
    widths = known.groupBy(F.size("vec").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if widths is None:
        return spark.createDataFrame([], schema)
    width, many = widths
    rows, queries = plain(rows, width), plain(queries, width)
    wanted = min(max(sample, int(SAMPLE_BY_ROOT * many**0.5)), max(1, SAMPLE_NUMBERS // width))
    drawn = _packed(rows.withColumn("h", F.xxhash64("id", F.lit(11))).orderBy("h", "id").limit(wanted))
    x = _rows_of(drawn.pop("vec"), width)
    # A leaf holds about half as many rows as the root of their number, where the sample is large enough to say so.
    tree = fit(_unit(x), int(min(LEAF, max(LEAST_LEAF, len(x) / (2 * many**0.5)))))
    checks = min(CALIBRATION, len(x))
    least = calibrated(tree, rows, x[:checks], drawn["id"].to_numpy()[:checks], k, recall, width)

    groups = min(GROUPS, tree.n_leaves)
    shared = spark.sparkContext.broadcast(tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = assign(shared.value, _unit(_matrix(batch.column("vec"), width)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf.astype(np.int32)), pa.array((leaf * groups // tree.n_leaves).astype(np.int32))],
                ["id", "vec", "leaf", "grp"],
            )

    indexed = keep(rows.mapInArrow(tidy(index), "id long, vec array<double>, leaf int, grp int"), "index")
    held = np.zeros(tree.n_leaves, np.int64)
    for r in indexed.groupBy("leaf").count().toLocalIterator():  # as many rows as leaves
        held[r.leaf] = r["count"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, group, leaves = [], [], []
            for i, q in enumerate(_unit(_matrix(batch.column("vec"), width))):
                met: dict[int, list[int]] = {}
                for leaf in visits(shared.value, q, least, held, 2 * k):
                    met.setdefault(leaf * groups // tree.n_leaves, []).append(leaf)
                for g, found in met.items():
                    row.append(i)
                    group.append(g)
                    leaves.append(found)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("vec").take(at), pa.array(group, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))],
                ["id", "vec", "grp", "leaves"],
            )

    walks = keep(queries.mapInArrow(tidy(walk), "id long, vec array<double>, grp int, leaves array<int>"), "walks")
    blocks = {
        r.grp: (ceil(r.n / BLOCK_ROWS), ceil((r.m or 0) / BLOCK_QUERIES))
        for r in indexed.groupBy("grp").agg(F.count("*").alias("n"))
        .join(walks.groupBy("grp").agg(F.count("*").alias("m")), "grp", "left").collect()  # as many rows as groups
    }
    if not any(queries_ for _, queries_ in blocks.values()):
        return spark.createDataFrame([], schema)

    def dealt(df: DataFrame, own: int) -> DataFrame:
        """Each row once for every part of the other side that its part meets."""
        parts = F.create_map(*[F.lit(v) for g, sizes in blocks.items() for v in (g, max(1, sizes[own]))])
        others = F.create_map(*[F.lit(v) for g, sizes in blocks.items() for v in (g, sizes[1 - own])])
        mine = F.pmod(F.xxhash64("id", F.lit(own)), F.element_at(parts, F.col("grp"))).cast("int")
        many = F.element_at(others, F.col("grp"))
        theirs = F.when(many > 0, F.sequence(F.lit(0), F.greatest(many - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        names = ("rpart", "qpart")
        return df.withColumn(names[own], mine).withColumn(names[1 - own], F.explode(theirs))

    def meet(qs: pd.DataFrame, rs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(qs) and len(rs):
            q, x = np.array(qs["vec"].tolist(), np.float64), np.array(rs["vec"].tolist(), np.float64)
            qid, ids = qs["id"].to_numpy(), rs["id"].to_numpy()
            leaves, own = np.unique(rs["leaf"].to_numpy(), return_inverse=True)
            for at in range(0, len(q), 256):
                part = slice(at, at + 256)
                allowed = np.array([np.isin(leaves, found) for found in qs["leaves"].iloc[part]])[:, own]
                for n, place, score in top(q[part], qid[part], x, ids, k, allowed):
                    out += [(qid[at + n], ids[p], s) for p, s in zip(place, score, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    near = (
        dealt(walks, 1)
        .groupBy("grp", "rpart", "qpart")
        .cogroup(dealt(indexed, 0).groupBy("grp", "rpart", "qpart"))
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    )
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 50 = 0"))

"""Near-duplicates by an exact Jaccard join over word n-grams, with grouped prefix filtering.

A document's set holds the hashes of its n-grams. Equal sets become one class at once. In a global order of n-grams, rare
ones first, two similar sets share an n-gram of their prefixes. Classes with the same prefix and size form one group; the
index holds groups, pairs of groups are filtered by length and position, then expanded to their members and verified in full.

The result is the components of links, so pairs within a component needn't all be compared. Each group is first
compared with one member of each of a few of its buckets (`STARS`), that with most frequent n-grams or one drawn by hash, where
a sketch of 64 bits says that the two are alike; this ties large groups of near copies together in linear time. The sketch may
be wrong, as these pairs only come first: after them every remaining pair that may be similar and isn't yet in one component
is compared. No link between components is lost, and no copies are expanded into all pairs. Members of a large bucket are dealt
by the size of their sets, as only sets of like sizes can link, then into blocks of bounded size; pairs of blocks are weighed
by what both sets hold of each part of the n-grams, and only pairs that may link leave them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import HOT_KEYS, HOT_ROWS, crowded, discard, dropping_shuffles, hashed_words, hot_keys, join_skewed, keep, may_contain, membership, mixed, most_frequent, spread, steps, table, text_or_empty, tidy

SHINGLE, PERCENT = 4, 85
#: In how many of its buckets a group may meet one member at first, and with how many of these it is compared.
STARS, CENTRES = 6, 2
#: Bits of the sketch, and in how many of them sets may differ that are compared first. Of sets that link some five differ.
SKETCH, UNLIKE = 64, 18
#: n-grams in so many prefixes go to the end of the order, by their number; so many of them are known to all tasks at most.
HEAVY, HEAVY_KNOWN = 48, 1 << 18
#: A bucket of more members is weighed in blocks of so many.
SMALL_BUCKET, BLOCK = 24, 1500
#: Into so many parts grams are dealt by hash; what two sets have of each part bounds what they share.
PARTS, COARSE = 512, 128
#: Bytes of text, and rows, of one step.
STEP, ROWS = 2 << 20, 2048
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
Sets = tuple[np.ndarray, np.ndarray]


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> Sets:
    """The sorted distinct hashes of all texts' n-grams in a row, and where each text's begin (with the end).

    A text of fewer words than `width` has its whole sequence as its one n-gram, and one without words has none.
    """
    _, _, _, offsets, words = hashed_words(texts, lower=True)
    with np.errstate(over="ignore"):
        grams = np.full(max(0, len(words) - width + 1), np.uint64(width))
        for k in range(width):
            grams = grams * _A + words[k : k + len(grams)]
        grams = mixed(grams)
        parts = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if b - a >= width:
                parts.append(np.unique(grams[a : b - width + 1]))
            elif b > a:
                one = np.uint64(b - a)
                for w in words[a:b]:
                    one = one * _A + w
                parts.append(mixed(np.array([one], np.uint64)))
            else:
                parts.append(words[:0])
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else words[:0]), np.r_[0, np.cumsum(size)]


def digests(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (_A, _B):
            sums = np.r_[np.uint64(0), np.cumsum(mixed(values ^ salt), dtype=np.uint64)]
            out.append(mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64 bits of each set: one of the least hash in each 64th of their range, 0 where there is none. values: in order in each set."""
    n = len(bounds) - 1
    bin_ = np.repeat(np.arange(n), np.diff(bounds)) * SKETCH + (values >> np.uint64(58)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bin_[1:] != bin_[:-1]])) if len(values) else np.empty(0, np.int64)
    bits = np.zeros(n * SKETCH, np.uint8)
    bits[bin_[first]] = (values[first] & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits.reshape(-1, SKETCH), axis=1).view("<i8").reshape(-1)


def prefix_size(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """A set of n that shares enough with another shares one of its first n - ceil(n * percent / 100) + 1."""
    return n - (n * percent + 99) // 100 + 1


def _first(bounds: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the first size[i] values of each set."""
    ends = np.cumsum(size)
    return np.repeat(bounds[:-1] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _lists(values: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(values.view(np.int64)))


def _early(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text", STEP, ROWS):
        values, bounds = shingle_sets(batch.column("text"), width)
        n = np.diff(bounds)
        p = prefix_size(n, percent)
        size = np.minimum(n, p + p // 4 + 4)
        yield pa.RecordBatch.from_arrays([_lists(values[_first(bounds, size)], size)], ["grams"])


def _signed(batches: Iterator[pa.RecordBatch], heavy, width: int, percent: int) -> Iterator[pa.RecordBatch]:
    known, weight = heavy.value
    for batch in steps(batches, "text", STEP, ROWS):
        values, bounds = shingle_sets(batch.column("text"), width)
        n = np.diff(bounds)
        s1, s2 = digests(values, bounds)
        drawn = sketches(values, bounds)
        rank = np.zeros(len(values), np.uint8)
        if len(known):
            at = np.minimum(np.searchsorted(known, values), len(known) - 1)
            hit = known[at] == values
            rank[hit] = weight[at[hit]]
        owner = np.repeat(np.arange(len(n)), n)
        often = np.bincount(owner, rank > 0, len(n)).astype(np.int64)
        moved = np.unique(owner[rank > 0])  # only these leave the order by hash
        if len(moved):
            mask = np.isin(owner, moved)
            place = np.flatnonzero(mask)
            values[place] = values[place[np.lexsort((values[place], rank[place], owner[place]))]]
        held = np.bincount(owner * PARTS + (values >> np.uint64(55)).astype(np.int64), minlength=len(n) * PARTS).reshape(-1, PARTS)
        parts = np.minimum(held, 255).astype(np.uint8)
        size = np.where(n > 0, prefix_size(n, percent), 0)
        head = values[_first(bounds, size)]
        p1, p2 = digests(head, np.r_[0, np.cumsum(size)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("text_key"), *(pa.array(x) for x in (n, s1, s2, p1, p2, often, drawn)), pa.array([x.tobytes() for x in parts], pa.binary()), _lists(head, size)],
            ["id", "text_key", "n", "s1", "s2", "p1", "p2", "often", "sketch", "parts", "prefix"],
        )


def _live(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    bits = np.frombuffer(shared.value, np.uint8)
    for batch in batches:
        lists = batch.column("prefix")
        values = lists.flatten().to_numpy(zero_copy_only=False)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        at = np.arange(len(values)) - np.repeat(bounds[:-1], np.diff(bounds))
        live = may_contain(bits, values)
        new = np.r_[0, np.cumsum(live)][bounds].astype(np.int32)
        nth = np.arange(new[-1], dtype=np.int32) - np.repeat(new[:-1], np.diff(new))
        rows = pa.StructArray.from_arrays(
            [pa.array(values[live]), pa.array(at[live].astype(np.int32)), pa.array(nth)], ["gram", "at", "nth"]
        )
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("gid", "n", "often", "sketch")), pa.ListArray.from_arrays(pa.array(new), rows)],
            ["gid", "n", "often", "sketch", "grams"],
        )


def _bounded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that may share enough: of each part, two sets share no more than the smaller number they have of it."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, PARTS) for c in ("px", "py"))
        n, m = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
        most = np.minimum(a, b).sum(1, dtype=np.int64)
        full = (a == 255).any(1) | (b == 255).any(1)  # as many or more
        yield batch.filter(pa.array(full | ((100 + percent) * most >= percent * (n + m)))).select(["x", "y"])


def _sets_of(batches: Iterator[pa.RecordBatch], wanted, width: int) -> Iterator[pa.RecordBatch]:
    bits = np.frombuffer(wanted.value, np.uint8)
    for batch in batches:
        batch = batch.filter(pa.array(may_contain(bits, batch.column("key").to_numpy())))
        for part in steps([batch], "text", STEP, ROWS):
            values, bounds = shingle_sets(part.column("text"), width)
            s1, s2 = digests(values, bounds)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(s1), pa.array(s2), _lists(values, np.diff(bounds))], ["id", "s1", "s2", "grams"]
            )


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable. edges: a, b.

    In each round every node points to its least neighbour, if that is less, and pointers are followed to their roots; edges
    then run between roots, and those within one go. At least half of the nodes go each round, mostly all but a few. Each
    round's tables are written to the shared folder; nodes of very many edges are told to all tasks, so that their edges stay
    where they are.
    """
    left = keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while left.limit(1).count():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("near")).union(left.select("b", "a"))
        kept = keep(both.groupBy("node").agg(F.least("node", F.min("near")).alias("root"), F.count("*").alias("n")), "roots")
        first, hot = kept, most_frequent(kept.where(F.col("n") > HOT_ROWS), "n", HOT_KEYS).select("node")
        hot = hot if hot.limit(1).count() else None
        hot_as = lambda name: hot and hot.withColumnRenamed("node", name)  # noqa: B023, E731
        while True:
            up = kept.select(F.col("node").alias("root"), F.col("root").alias("up"))
            after = join_skewed(kept.select("node", "root"), up, "root", hot_as("root")).select("node", F.col("up").alias("root"), F.col("root").alias("was"))
            after = keep(after, "roots")
            if kept is not first:  # which hot nodes are read from
                discard(kept)
            kept = after
            if not kept.where("root <> was").limit(1).count():
                break
        roots = kept.select("node", "root")
        if labels is None:
            labels = keep(roots.withColumnRenamed("root", "label"), "labels")
        else:  # what pointed to a root of the rounds before points to that one's root now
            up = roots.withColumnsRenamed({"node": "label", "root": "far"})
            after = join_skewed(labels, up, "label", hot_keys(labels, "label"), "left").select("node", F.coalesce("far", "label").alias("label"))
            after = keep(after, "labels")
            discard(labels)
            labels = after
        moved = left
        for side in ("a", "b"):
            moved = join_skewed(moved, roots.withColumnsRenamed({"node": side, "root": f"{side}_root"}), side, hot_as(side))
        ends = [F.col("a_root"), F.col("b_root")]
        after = keep(moved.where("a_root <> b_root").select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct(), "edges")
        discard(left, kept, first)
        left = after
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("label"))


class _Join:
    """One run of the join. docs: id, text."""

    def __init__(self, docs: DataFrame, width: int, percent: int) -> None:
        self.docs, self.width, self.percent = docs, width, percent
        self.spark = docs.sparkSession
        self.share = self.spark.sparkContext.broadcast

    def heavy(self) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams that come last, sorted, and the power of two of their number. HEAVY_KNOWN at most; any choice gives
        the same result, as the order need only be the same for all documents."""
        grams = self.docs.select("text").mapInArrow(
            tidy(partial(_early, width=self.width, percent=self.percent)), "grams array<long>"
        )
        counted = grams.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
        counted = keep(counted.where(F.col("n") >= HEAVY), "heavy")
        with dropping_shuffles(self.spark):
            top = most_frequent(counted, "n", HEAVY_KNOWN).toPandas()
        discard(counted)
        known = top["gram"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(known)
        return known[order], np.log2(np.maximum(1, top["n"].to_numpy(float))).astype(np.uint8)[order]

    def index(self) -> None:
        """Tables: rows (id, text_key, n, s1, s2), members (node, gid, n, low, s1, s2, parts), postings (gram, at, nth, gid, n, often, sketch)."""
        heavy = self.share(self.heavy())
        signed = keep(
            self.docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(
                tidy(partial(_signed, heavy=heavy, width=self.width, percent=self.percent)),
                "id long, text_key long, n long, s1 long, s2 long, p1 long, p2 long, often long, sketch long, parts binary, prefix array<long>",
            ),
            "signed",
        )
        heavy.destroy()
        self.rows = keep(signed.select("id", "text_key", "n", "s1", "s2"), "rows")
        classes = (
            signed.where("n > 0")
            .groupBy("s1", "s2")
            .agg(F.min("id").alias("low"), F.min("n").alias("n"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.any_value("parts").alias("parts"))
        )
        classes = keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        groups = signed.where("n > 0").groupBy("p1", "p2", "n").agg(F.any_value("prefix").alias("prefix"), F.max("often").alias("often"), F.min("sketch").alias("sketch"))
        groups = keep(groups.withColumn("gid", F.monotonically_increasing_id()), "groups")
        discard(signed)
        self.members = keep(classes.join(groups.drop("prefix", "often", "sketch"), ["p1", "p2", "n"]).drop("p1", "p2"), "members")
        grams = groups.select(F.explode("prefix").alias("gram")).groupBy("gram").agg(F.count("*").alias("c")).where("c > 1")
        names = ("gid", "n", "often", "sketch")
        several = membership(grams, "gram")
        if crowded(several):
            each = groups.select(*names, F.posexplode("prefix").alias("at", "gram")).join(grams.select("gram"), "gram", "left_semi")
            nth = F.row_number().over(W.partitionBy("gid").orderBy("at")) - 1
            live = each.select(*names, "gram", F.col("at").cast("int").alias("at"), nth.cast("int").alias("nth"))
        else:
            found = groups.select(*names, "prefix").mapInArrow(
                tidy(partial(_live, shared=self.share(several))), "gid long, n long, often long, sketch long, grams array<struct<gram: long, at: int, nth: int>>"
            )
            live = found.select(*names, F.inline("grams"))
        self.postings = keep(live, "postings")
        discard(classes, groups)

    def possible(self, a: str, b: str) -> Column:
        """Whether groups that share an n-gram at the places a.at and b.at can be similar: by length and position.

        Of the first n-gram that two prefixes share, the bound holds for whatever both have from there on.
        """
        n, m, i, j = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.at", f"{b}.at"))
        most = F.least(n - i, m - j)
        p = self.percent
        return (100 * F.least(n, m) >= p * F.greatest(n, m)) & ((100 + p) * most >= p * (n + m))

    def stars(self) -> DataFrame:
        """Pairs of groups (a, b): each group with the most alike of the centres of its first STARS buckets."""
        postings = self.postings.where(F.col("nth") < STARS)
        turn = F.pmod(F.col("gram"), F.lit(STARS))
        chance = F.xxhash64("gid", turn)
        # A text with most frequent n-grams is nearest to the others of its kind.
        first = F.when(turn % 2 == 0, -F.col("often") / F.col("n")).otherwise(chance / F.lit(float(1 << 63)))
        drawn = F.struct(first.alias("f"), chance.alias("h"), "gid", "n", "at", "sketch")
        # Numbers of members first: postings let through by the filter alone have no partner.
        centres = postings.groupBy("gram").agg(F.min(drawn).alias("c"), F.count("*").alias("k")).where("k > 1")
        centres = centres.select("gram", *(F.col(f"c.{x}").alias(x) for x in ("gid", "n", "at", "sketch")))
        a, b = centres.alias("a"), postings.alias("b")
        differ = F.bit_count(F.col("a.sketch").bitwiseXOR(F.col("b.sketch")))
        met = a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.gid") != F.col("b.gid")) & (differ <= UNLIKE) & self.possible("a", "b"))
        nearest = met.groupBy(F.col("b.gid").alias("b")).agg(F.array_sort(F.collect_set(F.struct(differ.alias("d"), F.col("a.gid").alias("a")))).alias("x"))
        return nearest.select("b", F.explode(F.slice("x", 1, CENTRES)).alias("x")).select("x.a", "b")

    def expanded(self, pairs: DataFrame) -> DataFrame:
        """Pairs of members of pairs of groups: the first member of a with every member of b."""
        heads = self.members.groupBy("gid").agg(F.min("node").alias("x"))
        right = self.members.select(F.col("gid").alias("b"), F.col("node").alias("y"))
        return pairs.join(heads.withColumnRenamed("gid", "a"), "a").join(right, "b").select("x", "y")

    def within(self) -> DataFrame:
        """Pairs of the first member of each group with its other members."""
        heads = self.members.groupBy("gid").agg(F.min("node").alias("x"), F.count("*").alias("k")).where("k > 1")
        return heads.join(self.members.select("gid", F.col("node").alias("y")), "gid").where("x <> y").select("x", "y")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough, as edges (a, b); pairs: x, y."""
        pairs = keep(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "pairs")
        side = lambda c: self.members.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("parts").alias(f"p{c}"))
        likely = pairs.join(side("x"), "x").join(side("y"), "y").mapInArrow(tidy(partial(_bounded, percent=self.percent)), "x long, y long")
        likely = keep(likely, "likely")
        discard(pairs)
        pairs = likely
        involved = pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node"))).distinct()
        classes = self.members.join(involved, "node").select("node", "low", "s1", "s2")
        classes = keep(classes, "involved")
        wanted, docs = membership(classes.select(spread("low").alias("key")), "key"), self.docs
        if crowded(wanted):
            lows = classes.select("low").distinct()
            docs = docs.join(lows, docs["id"].eqNullSafe(lows["low"]), "left_semi")
        sets = docs.select("id", "text", spread("id").alias("key")).mapInArrow(
            tidy(partial(_sets_of, wanted=self.share(wanted), width=self.width)), "id long, s1 long, s2 long, grams array<long>"
        )
        same = sets["id"].eqNullSafe(classes["low"]) & (sets["s1"] == classes["s1"]) & (sets["s2"] == classes["s2"])
        sets = keep(sets.join(classes, same).select("node", "grams").dropDuplicates(["node"]), "sets")
        x = sets.select(F.col("node").alias("x"), F.col("grams").alias("g"))
        y = sets.select(F.col("node").alias("y"), F.col("grams").alias("h"))
        shared = F.size(F.array_intersect("g", "h"))
        p = self.percent
        enough = (100 + p) * shared >= p * (F.size("g") + F.size("h"))
        found = pairs.join(x, "x").join(y, "y").where(enough).select(F.col("x").alias("a"), F.col("y").alias("b"))
        found = keep(found, "links")
        discard(pairs, classes, sets)
        return found

    def remaining(self, labels: DataFrame) -> DataFrame:
        """Pairs of members that may be similar and aren't in one component yet. labels: node, label."""
        held = self.members.join(labels, "node", "left").select("gid", "node", F.coalesce("label", "node").alias("label"))
        held = keep(held, "held")
        span = keep(held.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m")), "spans")
        posted = self.postings.join(span, "gid")
        mixed_buckets = posted.groupBy("gram").agg(F.min("lo").alias("l"), F.max("hi").alias("h"), F.sum("m").alias("k")).where("l < h")
        posted = keep(posted.join(mixed_buckets.select("gram", "k"), "gram").select("gram", "at", "gid", "n", "lo", "hi", "k"), "remaining")
        few = posted.where(F.col("k") <= SMALL_BUCKET)
        a, b = few.alias("a"), few.alias("b")
        apart = (F.col("a.lo") != F.col("b.hi")) | (F.col("a.hi") != F.col("b.lo"))
        met = a.join(
            b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.gid") < F.col("b.gid")) & apart & self.possible("a", "b")
        )
        groups = met.select(F.col("a.gid").alias("a"), F.col("b.gid").alias("b")).distinct()
        left = held.select(F.col("gid").alias("a"), F.col("node").alias("x"), F.col("label").alias("lx"))
        right = held.select(F.col("gid").alias("b"), F.col("node").alias("y"), F.col("label").alias("ly"))
        cross = groups.join(left, "a").join(right, "b").where("lx <> ly").select("x", "y")  # SMALL_BUCKET members on either side at most
        # A group whose members aren't yet in one component is a bucket of its own.
        own = span.where("lo < hi").select(F.col("gid").alias("gram"), F.lit(0).alias("at"), "gid", F.col("m").alias("k")).join(self.members.select("gid", "n").distinct(), "gid")
        large = posted.where(F.col("k") > SMALL_BUCKET).select("gram", "at", "gid", "n", "k")
        return cross.union(self.weighed(large, held)).union(self.weighed(own.select("gram", "at", "gid", "n", "k"), held))

    def weighed(self, posted: DataFrame, held: DataFrame) -> DataFrame:
        """Pairs (x, y) of large buckets, of different components, that may link. posted: gram, at, gid, n, k (members of the bucket).

        A bucket of up to BLOCK members is one group. Members of a larger one are dealt by the size class of their sets, of which
        only neighbours can link, and within it into blocks; each pair of blocks is one group of 2 * BLOCK rows or so. A pair
        leaves only the first of the large buckets that it shares.
        """
        order = F.sort_array(F.collect_list(F.struct("at", "gram")))
        lists = posted.groupBy("gid").agg(F.transform(order, lambda x: x["gram"]).alias("grams"))
        size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / self.percent)) - 1e-9).cast("int")
        rows = posted.withColumn("size", F.when(F.col("k") > BLOCK, size).otherwise(0)).drop("k").join(held, "gid")
        classes = rows.groupBy("gram", "size").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        below = W.partitionBy("gram").orderBy("size")
        next_ = lambda c, by: F.when(F.lead("size", by).over(below) == F.col("size") + by, F.lead(c, by).over(below))
        differ = lambda by: (F.least("lo", next_("lo", by)) < F.greatest("hi", next_("hi", by))) & next_("lo", by).isNotNull()
        classes = classes.select(
            "gram",
            "size",
            "blocks",
            F.when(F.col("lo") < F.col("hi"), F.col("blocks")).otherwise(0).alias("same"),
            F.when(differ(1), next_("blocks", 1)).otherwise(0).alias("above"),
            F.when(differ(-1), next_("blocks", -1)).otherwise(0).alias("under"),
        ).where("same + above + under > 0")
        rows = rows.join(classes, ["gram", "size"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        many = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.greatest(F.col(c) - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        cell = lambda low, i, j, side: F.struct(low.alias("low"), i.alias("i"), j.alias("j"), side.alias("side"))
        one, own = F.col("size"), F.col("own")
        # side: 0 for the first block of a pair, 1 for the second, 2 for a block that meets itself; j counts from -1 down within a class.
        met = F.concat(
            F.transform(many("same"), lambda k: cell(one, F.least(own, k), -1 - F.greatest(own, k), F.when(own == k, 2).when(own < k, 0).otherwise(1))),
            F.transform(many("above"), lambda k: cell(one, own, k, F.lit(0))),
            F.transform(many("under"), lambda k: cell(one - 1, k, own, F.lit(1))),
        )
        rows = rows.join(lists, "gid").join(self.members.select("node", "parts"), "node").withColumn("cell", F.explode(met))
        rows = rows.select("gram", "cell.low", "cell.i", "cell.j", "cell.side", "node", "n", "at", "label", "parts", "grams")
        percent = self.percent

        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            none = np.empty(0, np.int64)
            out_x, out_y = [none], [none]
            side = rows["side"].to_numpy()
            if (side != 1).any() and (side != 0).any() and rows["label"].nunique() > 1:
                rows = rows.sort_values("n", kind="stable")
                side = rows["side"].to_numpy()
                within = (side == 2).any()
                firsts, seconds = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
                all_n, all_at, all_label, all_node = (rows[c].to_numpy(np.int64) for c in ("n", "at", "label", "node"))
                all_parts = np.frombuffer(b"".join(rows["parts"]), np.uint8).reshape(-1, PARTS)
                all_rough = all_parts.reshape(-1, COARSE, PARTS // COARSE).sum(2, dtype=np.uint16)
                all_full = (all_parts == 255).any(1)
                grams = rows["grams"].tolist()
                held: dict[int, frozenset] = {}
                n = all_n[seconds]
                low = np.searchsorted(n, -(-percent * all_n[firsts] // 100), "left")
                high = np.searchsorted(n, 100 * all_n[firsts] // percent, "right")
                for i, a, b in zip(firsts.tolist(), low.tolist(), high.tolist(), strict=True):
                    place = seconds[a:b]  # of sizes that can link
                    need = percent * (n[a:b] + all_n[i])
                    near = (all_label[place] != all_label[i]) & ((100 + percent) * np.minimum(n[a:b] - all_at[place], all_n[i] - all_at[i]) >= need)
                    if within:
                        near &= all_node[place] > all_node[i]
                    place, need = place[near], need[near]
                    if not len(place):
                        continue
                    any_full = all_full[place] | all_full[i]
                    most = np.minimum(all_rough[place], all_rough[i]).sum(1, dtype=np.int64)
                    good = any_full | ((100 + percent) * most >= need)
                    place, need, any_full = place[good], need[good], any_full[good]
                    most = np.minimum(all_parts[place], all_parts[i]).sum(1, dtype=np.int64)
                    fits = place[any_full | ((100 + percent) * most >= need)].tolist()
                    if not fits:
                        continue
                    mine = grams[i].tolist()
                    for j in fits:
                        if j not in held:
                            held[j] = frozenset(grams[j].tolist())
                    fits = [j for j in fits if next(g for g in mine if g in held[j]) == key[0]]
                    out_x.append(np.full(len(fits), all_node[i]))
                    out_y.append(all_node[fits])
            return pd.DataFrame({"x": np.concatenate(out_x), "y": np.concatenate(out_y)})

        return rows.groupBy("gram", "low", "i", "j").applyInPandas(run, "x long, y long")

    def run(self) -> DataFrame:
        self.index()
        edges = self.linked(self.expanded(self.stars()).union(self.within()))
        labels = components(edges)
        more = self.linked(self.remaining(labels))
        edges = edges.union(more)
        labels = components(edges)
        placed = self.members.join(labels, "node", "left").select("node", "low", "s1", "s2", F.coalesce("label", "node").alias("label"))
        placed = keep(placed, "placed")
        smallest = placed.groupBy("label").agg(F.min("low").alias("component_id"))
        found = placed.join(smallest, "label").select("s1", "s2", "label", "component_id")
        return self.rows.join(found, ["s1", "s2"], "left").select(
            "id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
            "text_key",
            "label",
        )


def near_components(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links, itself included), text_key
    (a hash of the text) and label (a number of the component; null for a text without words).

    Words are lower-cased in A-Z. Two documents link when 100 * |intersection| >= percent * |union| of their sets. Texts
    without words have an empty set and link with nothing, not even with each other. Ids are integers; null ids don't count as
    smallest unless a component has no other. Rows that share an id are documents of their own. Other columns aren't read. An
    empty table gives an empty result. n-grams are compared by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return _Join(rows, width, percent).run().withColumnRenamed("id", id_col)


def drop_near_copies(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component, that of the smallest id, and every text without words, with all their columns.

    Of documents of a component that share the smallest id, one text stays; rows equal in id and text stay together.
    """
    found = near_components(docs, width, percent, id_col, text_col).withColumnRenamed(id_col, "_id")
    least = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "text_key")).alias("x")
    stay = found.where("n_shingles > 0").groupBy("label").agg(least).select("x._id", "x.text_key")
    stay = stay.union(found.where("n_shingles = 0").select("_id", "text_key"))
    same = docs[id_col].cast("long").eqNullSafe(stay["_id"]) & (F.xxhash64(text_or_empty(text_col)) == stay["text_key"])
    return docs.join(stay, same, "left_semi").select(*docs.columns)


SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
),
t as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as i from w),
g as (select doc_id, string_agg(word, ' ') over k as gram, count(*) over k as size, count(*) over (partition by doc_id) as n
      from t window k as (partition by doc_id order by i rows between current row and 3 following)),
s as (select distinct doc_id, gram from g where size = 4 or (n < 4 and size = n)),
c as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.gram = b.gram and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
e as (select a, b from p join c x on x.doc_id = a join c y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
both_ways as (select a, b from e union all select b, a from e),
reach as (select doc_id as a, doc_id as b from documents union select r.a, f.b from reach r join both_ways f on f.a = r.b)
select d.doc_id, coalesce(c.n, 0) as n_shingles, m.component_id
from documents d left join c using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by a) m using (doc_id)
"""


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    found = near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")

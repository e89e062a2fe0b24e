"""Hard negatives by a vantage-point tree over norm-augmented vectors.

With one more coordinate, sqrt(M^2 - |x|^2) for a row and 0 for a query, the squared distance of query q and row x is
|q|^2 + M^2 - 2 q.x, so the highest scores are the nearest rows and a window of scores is an annulus of distances.

The upper levels of the tree are fitted on a bounded sample and send each row to a region; a region's rows are dealt to blocks of
bounded size, and each block is a tree of its own, built where its rows are. What is known of a region or of a leaf is the range
of its rows' distances to the vantage points above it, taken over all rows, so the triangle inequality bounds its scores exactly.
A query first visits the region that may hold its highest score; the k-th score found there rules out most of the others, and the
rest are visited in a second pass. In a block, leaves are visited nearest first until no other can hold a better row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paratope.llm.common import Scratch

SAMPLE = 20_000  # rows that the upper levels are fitted on, at most
REGIONS = 4096  # regions, at most
BLOCK = 8192  # rows of a block, about
LEAF = 256  # rows of a leaf, at most
QUERIES = 512  # queries that a block answers at once
SHARE = 100_000  # queries of a region that one copy of its blocks answers
WIDEST = 1 << 22  # components are smaller than this in size
NONE = np.iinfo(np.int64).min
FAR = 1 << 52  # an open end of a window of scores


class Vantage:
    """A vantage-point tree over rows of a matrix: places are halved at the median distance to a point, whatever ties there are.

    Inner nodes lie in levels, so node i has children 2i + 1 and 2i + 2. ``groups`` are the rows of each leaf.
    """

    def __init__(self, rows: np.ndarray, depth: int, rng: np.random.Generator) -> None:
        self.depth, self.points = depth, np.zeros(((1 << depth) - 1, rows.shape[1]))
        self.cuts = np.zeros(len(self.points))
        groups = [np.arange(len(rows))]
        for level in range(depth):
            nxt = []
            for j, own in enumerate(groups):
                node = (1 << level) - 1 + j
                if len(own):
                    self.points[node] = rows[own[rng.integers(len(own))]]
                d = distances(rows[own], self.points[node][None, :])[:, 0]
                order = np.argsort(d, kind="stable")
                half = (len(own) + 1) // 2
                self.cuts[node] = d[order[half - 1]] if len(own) else 0.0
                nxt += [own[order[:half]], own[order[half:]]]
            groups = nxt
        self.groups = groups

    def route(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf that new rows belong to, and their distances to the points above it, level by level."""
        at, out = np.zeros(len(rows), dtype=np.int64), np.zeros((len(rows), self.depth))
        for level in range(self.depth):
            for node in np.unique(at).tolist():
                own = np.flatnonzero(at == node)
                d = distances(rows[own], self.points[node][None, :])[:, 0]
                out[own, level] = d
                at[own] = 2 * node + 1 + (d > self.cuts[node])
        return at - ((1 << self.depth) - 1), out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T), 0.0))


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    """Rows with the coordinate that gives all of them the squared norm ``most``."""
    return np.concatenate([x, np.sqrt(np.maximum(most - (x**2).sum(1), 0.0))[:, None]], axis=1)


def score_bounds(q: np.ndarray, most: float, points: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each query (row) may have in each set of rows (column).

    ``near`` and ``far`` (sets, points) are the ranges of a set's distances to the points; a range 0 to inf says nothing.
    """
    qa = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
    own = (q**2).sum(1)
    low, high = np.zeros((len(q), len(near))), np.full((len(q), len(near)), np.inf)
    for j, d in enumerate(distances(qa, points).T):
        low = np.maximum(low, np.maximum(d[:, None] - far[None, :, j], near[None, :, j] - d[:, None]))
        high = np.minimum(high, d[:, None] + far[None, :, j])
    total = (own + most)[:, None]
    slack = 1e-6 * (total + 1)  # of the roots and sums in floating point
    return (total - high**2) / 2 - slack, (total - np.maximum(low, 0.0) ** 2) / 2 + slack


def _levels(rows: int, size: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, rows / size)))))


class Block:
    """Rows of one block as a vantage-point tree, in ascending order of ids, so that a row's number breaks ties."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, most: float) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x, self.most = ids[order], labels[order], x[order], most
        a = augmented(self.x, most)
        tree = Vantage(a, _levels(len(a), LEAF), np.random.default_rng(len(a)))
        self.leaves = [g for g in tree.groups if len(g)]
        self.points = tree.points
        n = len(self.points)
        self.near, self.far = np.zeros((len(self.leaves), n)), np.full((len(self.leaves), n), np.inf)
        filled = [i for i, g in enumerate(tree.groups) if len(g)]
        for i, (leaf, g) in enumerate(zip(filled, self.leaves, strict=True)):
            node = leaf + n
            while node:
                node = (node - 1) // 2
                d = distances(a[g], self.points[node][None, :])
                self.near[i, node], self.far[i, node] = d.min(), d.max()
        self.bits = max(1, int(len(ids) - 1).bit_length())

    def best(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k highest scores between lo and hi (ties by id) among rows with, or without, the query's
        label, itself left out. Leaves are visited nearest first; a query is done when no leaf left can hold a better score."""
        low, high = score_bounds(q, self.most, self.points, self.near, self.far)
        high = np.where((low <= hi[:, None]) & (high >= lo[:, None]), np.minimum(high, hi[:, None]), -np.inf)
        order = np.argsort(-high, axis=1, kind="stable")
        top = np.full((len(q), k), NONE)  # score * 2**bits + what ranks smaller ids higher
        last = (1 << self.bits) - 1
        for step in range(order.shape[1]):
            leaf = order[:, step]
            bound = high[np.arange(len(q)), leaf]
            active = np.flatnonzero((bound > -np.inf) & ((top[:, -1] == NONE) | (bound >= (top[:, -1] >> self.bits))))
            if not len(active):
                break
            for v in np.unique(leaf[active]).tolist():
                own, rows = active[leaf[active] == v], self.leaves[v]
                s = np.rint(q[own] @ self.x[rows].T).astype(np.int64)
                fits = (s >= lo[own, None]) & (s <= hi[own, None]) & (self.ids[rows][None, :] != ids[own, None])
                fits &= (self.labels[rows][None, :] == labels[own, None]) == same[own, None]
                keys = np.where(fits, (s << self.bits) + (last - rows)[None, :], NONE)
                both = np.concatenate([top[own], keys], axis=1)
                top[own] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)[:, ::-1]
        at, rank = np.nonzero(top != NONE)
        found = top[at, rank]
        return at, last - (found & last), found >> self.bits


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten()).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


@dataclass
class Regions:
    """What is known of the regions (by their numbers, ascending): small, and sent to every task."""

    dim: int
    most: dict[int, float]  # the greatest squared norm of the vectors of each length
    tree: Vantage
    numbers: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores of queries of one length in each region; the greatest is -inf where the length differs."""
        of = np.where(self.numbers >= 0, self.dim, -self.numbers)
        fits, tree = of == q.shape[1], self.numbers >= 0
        low, high = np.full((len(q), len(of)), -np.inf), np.full((len(q), len(of)), -np.inf)
        if (fits & tree).any():
            low[:, tree], high[:, tree] = score_bounds(q, self.most[self.dim], self.tree.points, self.near[tree], self.far[tree])
        high[:, fits & ~tree] = np.inf
        return low, high


class Index:
    """Rows dealt to regions and blocks: ``rows`` (region, block, id, label, v) is a written table; the rest is small.

    Vectors of the commonest length are in the tree's regions (0 up); those of another length n are in a region of their own, -n,
    of which nothing is known.
    """

    def __init__(self, vectors: DataFrame, scratch: Scratch, seed: int = 11) -> None:
        """``vectors``: (id long, label long, v array<int>), none null; ids are unique."""
        self.scratch, self.spark = scratch, vectors.sparkSession
        sizes = {r.n: r for r in vectors.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("most")).collect()}
        most_of = {n: float(r.most) for n, r in sizes.items()}
        dim = max(sizes, key=lambda n: (sizes[n].rows, n)) if sizes else 0
        total, most = (sizes[dim].rows, most_of[dim]) if sizes else (0, 0.0)
        depth = min(_levels(total, BLOCK), int(np.log2(REGIONS)))
        fitted = np.zeros((0, dim))
        if depth:
            some = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) <= int((1 << 30) * min(1.0, SAMPLE / total))
            fitted = _matrix(vectors.where((F.size("v") == dim) & some).select("v").limit(2 * SAMPLE).toArrow().column("v"))
            depth = depth if len(fitted) else 0
        tree = Vantage(augmented(fitted if len(fitted) else np.zeros((0, dim)), most), depth, np.random.default_rng(seed))
        tree.groups = None

        def deal(batches):
            for b in batches:
                n = np.asarray(b.column("n"))
                for size in np.unique(n).tolist():
                    part = b.filter(pa.array(n == size))
                    v = part.column("v")
                    region, d = tree.route(augmented(_matrix(v), most)) if size == dim else (np.full(len(v), -size), np.zeros((len(v), depth)))
                    ways = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * depth), pa.array(d.ravel(), pa.float64()))
                    yield pa.RecordBatch.from_arrays([pa.array(region), part.column("id"), part.column("label"), v.cast(pa.list_(pa.int32())), ways], names=["region", "id", "label", "v", "d"])

        dealt = scratch.table(vectors.withColumn("n", F.size("v")).mapInArrow(deal, "region long, id long, label long, v array<int>, d array<double>"))
        stats = dealt.groupBy("region").agg(F.count("*").alias("n"), *(f(F.col("d")[i]).alias(f"{k}{i}") for i in range(depth) for k, f in (("near", F.min), ("far", F.max)))).orderBy("region").collect()
        near, far = np.zeros((len(stats), len(tree.points))), np.full((len(stats), len(tree.points)), np.inf)
        for i, r in enumerate(stats):
            node = r.region + len(tree.points)
            for level in reversed(range(depth) if r.region >= 0 else ()):
                node = (node - 1) // 2
                near[i, node], far[i, node] = r[f"near{level}"], r[f"far{level}"]
        self.map = Regions(dim, most_of, tree, np.array([r.region for r in stats], dtype=np.int64), near, far)
        self.blocks = {r.region: -(-r.n // BLOCK) for r in stats}
        few = self.spark.createDataFrame(list(self.blocks.items()), "region long, blocks long")
        self.rows = dealt.join(F.broadcast(few), "region").select("region", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "label", "v")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(a, p, rank, id, score): for each query (a, p, label, v, same, lo, hi) the k highest scores from lo to hi among rows of
        the same or of other labels, a itself left out. (a, p) names a query; ties go to smaller ids."""
        known, index_rows, spark = self.map, self.rows, self.spark
        kinds = "a long, p long, label long, v array<int>, same boolean, lo long, hi long"
        out = pa.schema([("region", pa.int64()), ("a", pa.int64()), ("p", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.int32())), ("same", pa.bool_()), ("lo", pa.int64()), ("hi", pa.int64()), ("home", pa.int64())])

        def visits(first: bool):
            def run(batches):
                for b in batches:
                    n = np.asarray(b.column("n"))
                    for size in np.unique(n).tolist():
                        whole = b.filter(pa.array(n == size))
                        for at in range(0, len(whole), 4096):
                            part = whole.slice(at, 4096)
                            q, lo, hi = _matrix(part.column("v")), np.asarray(part.column("lo")), np.asarray(part.column("hi"))
                            low, high = known.bounds(q)
                            may = (low <= hi[:, None]) & (high >= lo[:, None])
                            if not may.any():
                                continue
                            home = np.where(may, np.minimum(high, hi[:, None]), -np.inf).argmax(1)
                            if first:
                                row = np.flatnonzero(may.any(1))
                                region = known.numbers[home[row]]
                            else:
                                row, r = np.nonzero(may & (known.numbers[None, :] != np.asarray(part.column("home"))[:, None]))
                                region = known.numbers[r]
                            take = pa.array(row)
                            for i in range(0, len(row), 4096):
                                own = part.take(take.slice(i, 4096))
                                yield pa.RecordBatch.from_arrays([pa.array(region[i : i + 4096]), *(own.column(c) for c in ("a", "p", "label")), own.column("v").cast(pa.list_(pa.int32())), *(own.column(c) for c in ("same", "lo", "hi")), pa.array(region[i : i + 4096])], schema=out)

            return run

        def answers(visit: DataFrame) -> DataFrame:
            """Rows and queries of a block meet in one task, rows first; queries pass by in runs."""
            here = visit.groupBy("region").agg(F.count("*").alias("n")).collect()
            few = F.broadcast(spark.createDataFrame([(r.region, self.blocks[r.region], -(-r.n // SHARE)) for r in here], "region long, blocks long, shares long"))
            each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
            null = lambda kind: F.lit(None).cast(kind)
            rows = index_rows.join(few, "region").withColumn("share", each("shares"))
            rows = rows.select("region", "block", "share", F.lit(0).alias("kind"), F.col("id").alias("a"), null("long").alias("p"), "label", "v", null("boolean").alias("same"), null("long").alias("lo"), null("long").alias("hi"))
            asked = visit.join(few, "region").withColumn("block", each("blocks")).withColumn("share", F.pmod(F.xxhash64("a", "p"), F.col("shares")))
            asked = asked.select("region", "block", "share", F.lit(1).alias("kind"), "a", "p", "label", "v", "same", "lo", "hi")
            met = rows.unionByName(asked).repartition("region", "block", "share").sortWithinPartitions("region", "block", "share", "kind")
            most = known.most

            def run(batches):
                for block, region, q in _meetings(batches, most):
                    at, row, score = block.best(*q[2:], k)
                    if len(at):
                        yield pa.RecordBatch.from_pydict({"a": pa.array(q[0][at]), "p": pa.array(q[1][at]), "id": pa.array(block.ids[row]), "score": pa.array(score), "home": pa.array(np.full(len(at), region))})

            return met.mapInArrow(run, "a long, p long, id long, score long, home long")

        best = Window.partitionBy("a", "p").orderBy(F.desc("score"), "id")
        asked = self.scratch.table(queries.select(*(x.split()[0] for x in kinds.split(", ")), F.size("v").alias("n"), F.lit(0).cast("long").alias("home")))
        schema = f"region long, {kinds}, home long"
        near = self.scratch.table(asked.mapInArrow(visits(True), schema))
        one = self.scratch.table(answers(near.drop("home")))
        # The k-th score at home, if there are so many, is the least that matters; the home region isn't visited again.
        enough = one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).groupBy("a", "p").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("least"))
        again = near.select("a", "p", F.col("region").alias("home")).join(enough, ["a", "p"], "left")
        again = asked.drop("home").join(again, ["a", "p"]).withColumn("lo", F.greatest("lo", F.coalesce("least", "lo"))).drop("least")
        far = self.scratch.table(again.mapInArrow(visits(False), schema))
        two = self.scratch.table(answers(far.drop("home")))
        both = one.unionByName(two).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return self.scratch.table(both.select("a", "p", "rank", "id", "score"))


def _meetings(batches: Iterator[pa.RecordBatch], most: dict[int, float]):
    """(block, region, queries) of sorted rows (region, block, share, kind, a, p, label, v, same, lo, hi), some queries at a time."""
    names = ("a", "p", "v", "a", "label", "same", "lo", "hi")
    key, held, block = None, [], None

    def build():
        t = pa.Table.from_batches(held)
        x = _matrix(t.column("v"))
        return Block(np.asarray(t.column("a")), np.asarray(t.column("label")), x, most[x.shape[1]])

    for b in batches:
        cols = [np.asarray(b.column(i)) for i in range(4)]
        new = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)])) if len(b) else []
        for i, j in zip(new, [*new[1:], len(b)], strict=True):
            here, kind = tuple(c[i] for c in cols[:3]), cols[3][i]
            if here != key:
                key, held, block = here, [], None
            if kind == 0:
                held.append(b.slice(i, j - i))
            elif held:
                block = block or build()
                for lo in range(i, j, QUERIES):
                    part = b.slice(lo, min(QUERIES, j - lo))
                    q = [_matrix(part.column(c)) if c == "v" else np.asarray(part.column(c).cast(pa.int8())).astype(bool) if c == "same" else np.asarray(part.column(c)) for c in names]
                    yield block, here[0], q


def quantised(vectors: DataFrame, scale: float = 256.0, label: Column | None = None) -> DataFrame:
    """(id, label, v): components as floor(scale * x) of (vec_id, embedding, label), a row an id.

    Rows without id, label or vector, with null or non-finite components or with ones of 2**22 and more are left out; of rows that
    repeat an id the least (label, v) stays.
    """
    x = F.transform("embedding", lambda c: F.floor(F.lit(scale) * c.cast("double")))
    fits = F.coalesce(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(F.lit(scale) * c.cast("double")) < WIDEST)), F.lit(False))
    rows = vectors.where(F.col("vec_id").isNotNull() & fits & (F.size("embedding") > 0))
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"), x.cast("array<int>").alias("v")).where("label IS NOT NULL")
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each anchor and each of its positives, the nearest rows of other labels whose score lies between ``low`` and ``high`` percent
    of the positive's.

    Takes (id, label, v) as ``quantised`` gives it; ``anchors`` is a condition on those columns. A score is the integer inner product
    with the anchor; higher ones come first, ties by smaller id. Positives are the first ``positives`` other rows of the label.
    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score), all of them if there are fewer. A positive
    with a negative score has an empty window. Vectors of another length than the anchor's don't meet it. An empty table gives no
    rows. Vectors have fewer than 2**9 components of 2**22, or as many as keep sums under 2**48. Results are exact.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    rows = scratch.table(vectors.select("id", "label", "v"))
    index = Index(rows, scratch)
    asked = scratch.table(rows.where(anchors))
    every = asked.select(F.col("id").alias("a"), F.lit(0).cast("long").alias("p"), "label", "v", F.lit(True).alias("same"), F.lit(-FAR).cast("long").alias("lo"), F.lit(FAR).cast("long").alias("hi"))
    best = index.search(every, positives)
    # low * p <= 100 * n <= high * p in whole numbers
    pairs = best.select("a", F.col("id").alias("p"), F.col("score").alias("ps"))
    down = lambda c: ((c - F.pmod(c, F.lit(100))) / 100).cast("long")  # noqa: E731  the floor of a hundredth; exact, as sums stay under 2**53
    lo, hi = -down(F.lit(-low) * F.col("ps")), down(F.lit(high) * F.col("ps"))
    window = pairs.join(asked.withColumnRenamed("id", "a"), "a").select("a", "p", "label", "v", F.lit(False).alias("same"), lo.alias("lo"), hi.alias("hi"))
    found = index.search(window.where("lo <= hi"), negatives)
    return found.join(pairs, ["a", "p"]).select(F.col("a").alias("anchor_id"), F.col("p").alias("positive_id"), F.col("rank").cast("int"), F.col("id").alias("negative_id"), F.col("ps").alias("positive_score"), F.col("score").alias("negative_score"))


ORACLE = """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS a, e.id AS id, a.label = e.label AS same, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON a.id % 100 = 0 AND a.id <> e.id
), p AS (
  SELECT a, id AS p, score AS ps FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS k FROM s WHERE same) x WHERE k <= 5
), n AS (
  SELECT p.a, p, ps, id, score, row_number() OVER (PARTITION BY p.a, p ORDER BY score DESC, id) AS k
  FROM p JOIN s ON s.a = p.a AND NOT same AND 30 * ps <= 100 * score AND 100 * score <= 90 * ps
)
SELECT a AS anchor_id, p AS positive_id, CAST(k AS INT) AS rank, id AS negative_id, ps AS positive_score, score AS negative_score FROM n WHERE k <= 10"""


def mined(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth id. Every seventh row's label is moved on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(quantised(vectors, 256.0, moved), F.col("id") % 100 == 0)

"""Distances between motifs, UPGMA trees, k-medoids and redundancy filters.

Distances are computed by the cluster, a pair of motifs a row; trees and medoids work on one group's small matrix at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.operators.motifs import Motif


def euclid(a: Motif, b: Motif) -> float:
    """Root mean squared distance of the places' fractions, between 0 and 1."""
    return float(np.sqrt(((a.fractions - b.fractions) ** 2).sum(1) / 2).mean())


def divergence(a: Motif, b: Motif) -> float:
    """Symmetric Kullback-Leibler divergence per place."""
    p, q = np.maximum(a.fractions, 1e-9), np.maximum(b.fractions, 1e-9)
    return float(((p * np.log2(p / q) + q * np.log2(q / p)).sum(1) / 2).mean())


def sliding(a: Motif, b: Motif, distance: Callable[[Motif, Motif], float] = euclid, overlap: int = 6) -> tuple[float, int, bool]:
    """Least distance over all shifts with at least ``overlap`` places in common (at most the shorter width) and both strands, with
    the shift of b and whether it is reversed. Places that hang over are compared with background."""
    need = min(overlap, len(a), len(b))
    best = (float("inf"), 0, False)
    for flipped in (False, True):
        c = b.reverse() if flipped else b
        for shift in range(need - len(c), len(a) - need + 1):
            lo, hi = max(0, shift), min(len(a), shift + len(c))
            d = distance(a.part(lo, hi), c.part(lo - shift, hi - shift))
            if d < best[0] - 1e-12:
                best = (d, shift, flipped)
    return best


def average(motifs: list[Motif]) -> Motif:
    """The mean of motifs aligned to the one nearest to all others."""
    total = [sum(sliding(a, b)[0] for b in motifs) for a in motifs]
    centre = motifs[int(np.argmin(total))]
    rows = np.zeros_like(centre.fractions)
    for m in motifs:
        _, shift, flipped = sliding(centre, m)
        rows += (m.reverse() if flipped else m).part(-shift, len(centre) - shift).fractions
    return Motif(rows / len(motifs), centre.background)


def upgma(motifs: list[Motif], distance: Callable = lambda a, b: sliding(a, b)[0]) -> list[tuple[int, int, int, float]]:
    """Merges (node, left, right, distance): the closest pair becomes its average motif, to which distances are taken anew.

    Leaves are 0..n-1, later nodes follow; ties go to the pair of least numbers.
    """
    nodes = dict(enumerate(motifs))
    members = {i: [m] for i, m in nodes.items()}
    d = {(i, j): distance(nodes[i], nodes[j]) for i in nodes for j in nodes if i < j}
    out, nxt = [], len(motifs)
    while len(nodes) > 1:
        (i, j), best = min(d.items(), key=lambda x: (x[1], x[0]))
        out.append((nxt, i, j, best))
        members[nxt] = members.pop(i) + members.pop(j)
        del nodes[i], nodes[j]
        d = {k: v for k, v in d.items() if i not in k and j not in k}
        merged = average(members[nxt])
        d |= {(k, nxt): distance(nodes[k], merged) for k in nodes}
        nodes[nxt] = merged
        nxt += 1
    return out


def cut(merges: list[tuple[int, int, int, float]], n: int, most: float) -> list[list[int]]:
    """Clusters of leaves when only merges up to a distance are made."""
    groups = {i: [i] for i in range(n)}
    for node, i, j, d in merges:
        if d <= most and i in groups and j in groups:
            groups[node] = groups.pop(i) + groups.pop(j)
    return sorted(sorted(g) for g in groups.values())


def newick(merges: list[tuple[int, int, int, float]], names: list[str]) -> str:
    text = dict(enumerate(names))
    for node, i, j, d in merges:
        text[node] = f"({text[i]}:{d / 2:.4f},{text[j]}:{d / 2:.4f})"
    return text[max(text)] + ";"


def k_medoids(d: np.ndarray, k: int, seed: int = 0, rounds: int = 100) -> tuple[list[int], np.ndarray, float]:
    """Medoids, the medoid of each point and the sum of distances; a medoid is the point of least summed distance of its cluster."""
    medoids = sorted(np.random.default_rng(seed).choice(len(d), k, replace=False).tolist())
    for _ in range(rounds):
        own = np.array(medoids)[d[:, medoids].argmin(1)]
        new = sorted(int(g[d[np.ix_(g, g)].sum(0).argmin()]) for m in medoids for g in [np.flatnonzero(own == m)] if len(g))
        if new == medoids:
            break
        medoids = new
    own = np.array(medoids)[d[:, medoids].argmin(1)]
    return medoids, own, float(d[np.arange(len(d)), own].sum())


def k_medoids_runs(pairs: DataFrame, ks: list[int], seeds: list[int], most: int = 2000) -> DataFrame:
    """(k, seed, total, widest, nearest, medoids) of a run for each k and seed over the points of (i, j, d), each pair once.

    total: summed distance to the own medoid; widest: the largest one; nearest: the least distance between two medoids (null for
    one). Runs are dealt to tasks over a matrix that is sent to all; there are at most ``most`` points (32 MB), else ValueError.
    No pair gives no run.
    """
    spark = pairs.sparkSession
    way = pairs.schema["i"].dataType.simpleString()
    kinds = f"k int, seed int, total double, widest double, nearest double, medoids array<{way}>"
    points = sorted(r.p for r in pairs.select(F.explode(F.array("i", "j")).alias("p")).distinct().limit(most + 1).collect())
    if len(points) > most:
        raise ValueError(f"more than {most} points")
    if not points or not ks or not seeds:
        return spark.createDataFrame([], kinds)
    f = pairs.select("i", "j", "d").toPandas()
    place, m = {p: n for n, p in enumerate(points)}, np.zeros((len(points), len(points)))
    at, to = f["i"].map(place).to_numpy(), f["j"].map(place).to_numpy()
    m[at, to] = m[to, at] = f["d"].to_numpy()
    shared = spark.sparkContext.broadcast((m, points))

    def run(frames):
        m, points = shared.value
        for f in frames:
            for k, s in zip(f["k"], f["seed"], strict=True):
                medoids, own, total = k_medoids(m, min(int(k), len(m)), int(s))
                apart = m[np.ix_(medoids, medoids)][np.triu_indices(len(medoids), 1)]
                yield pd.DataFrame([(k, s, total, float(m[np.arange(len(m)), own].max()), float(apart.min()) if len(apart) else None, [points[x] for x in medoids])], columns=["k", "seed", "total", "widest", "nearest", "medoids"])

    grid = spark.createDataFrame([(k, s) for k in ks for s in seeds], "k int, seed int").repartition(min(len(ks) * len(seeds), 4 * spark.sparkContext.defaultParallelism))
    return grid.mapInPandas(run, kinds)


def best_run(runs: DataFrame, rule: str, bound: float = 0.15) -> DataFrame:
    """One of ``k_medoids_runs``, by an order over them: ``total`` or ``widest`` (the least of it), ``tight`` (the least k whose
    widest is within ``bound``), ``apart`` (the greatest k whose medoids are ``bound`` apart) or ``drop`` (the k at which the least
    total falls most against k - 1). Ties go to the least total, k and seed."""
    last = [F.asc("total"), F.asc("k"), F.asc("seed")]
    if rule in ("total", "widest"):
        rows, order = runs, [F.asc(rule)]
    elif rule == "tight":
        rows, order = runs.where(F.col("widest") <= bound), [F.asc("k")]
    elif rule == "apart":
        rows, order = runs.where(F.coalesce(F.col("nearest") >= bound, F.lit(True))), [F.desc("k")]
    elif rule == "drop":
        least = runs.groupBy("k").agg(F.min("total").alias("least"))
        before = least.select((F.col("k") + 1).alias("k"), F.col("least").alias("before"))
        rows, order = runs.join(least.join(before, "k"), "k"), [F.desc(F.col("before") - F.col("least"))]
    else:
        raise ValueError(f"no rule {rule!r}")
    return rows.orderBy(*order, *last).limit(1).select(*runs.columns)


def distinct_motifs(motifs: list[tuple[Motif, float]], most: float = 0.5) -> list[int]:
    """Places of motifs that stay when, best score first, each that lies within ``most`` of one already kept goes."""
    kept: list[int] = []
    for i in sorted(range(len(motifs)), key=lambda i: (-motifs[i][1], i)):
        if all(sliding(motifs[k][0], motifs[i][0])[0] > most for k in kept):
            kept.append(i)
    return sorted(kept)

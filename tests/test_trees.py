"""Average linkage of many groups at once against a direct merge of the closest pair, and motif distances against their definition."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paratope.operators import distances, trees
from paratope.operators.motifs import Motif


def direct(leaves, d):
    """Heights at which leaves meet when the closest pair of clusters merges, O(n^3)."""
    groups = [[x] for x in leaves]
    out = {}
    mean = lambda a, b: sum(d[min(x, y), max(x, y)] for x in a for y in b) / (len(a) * len(b))
    while len(groups) > 1:
        h, i, j = min((mean(a, b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        out |= {(min(x, y), max(x, y)): h / 2 for x in groups[i] for y in groups[j]}
        groups[i] += groups.pop(j)
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    leaves, pairs = [], {}
    for g, n in (("a", 23), ("b", 9), ("c", 2), ("alone", 1)):
        names = [f"{g}{i:02}" for i in range(n)]
        at = {x: (rng.random(), rng.random()) for x in names}
        leaves += [(g, x) for x in names]
        pairs[g] = {(x, y): abs(at[x][0] - at[y][0]) + abs(at[x][1] - at[y][1]) for x in names for y in names if x < y}
    rows = [(g, *(k if rng.random() < 0.5 else k[::-1]), d) for g, m in pairs.items() for k, d in m.items()]
    rng.shuffle(rows)
    return leaves, pairs, spark.createDataFrame(leaves + leaves[:3], "grp string, leaf string"), spark.createDataFrame(rows, "grp string, i string, j string, d double").repartition(3)


@pytest.mark.parametrize("small", [400, 6, 0])
def test_trees_equal_the_direct_merge(tables, monkeypatch, small):
    monkeypatch.setattr(trees, "SMALL", small)
    leaves, pairs, frame, links = tables
    merges, roots = trees.average_link(frame, links)
    rows = merges.collect()
    for g, d in pairs.items():
        own = sorted((r["round"], r.left, r.right, r.node, r.height) for r in rows if r.grp == g)
        got = trees.cophenetic([x[1:] for x in own])
        want = direct([x for h, x in leaves if h == g], d)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    text = {r.grp: r.newick for r in roots.collect()}
    assert set(text) == set(pairs) and text["alone"] == "alone00;"
    assert all(t.count("(") == t.count(")") == sum(h == g for h, _ in leaves) - 1 and all(x in t for h, x in leaves if h == g) for g, t in text.items())
    x, y = "c00", "c01"
    assert text["c"] == f"({x}:{pairs['c'][x, y] / 2:.6f},{y}:{pairs['c'][x, y] / 2:.6f});"
    cut = trees.clusters(frame, merges, 0.4).collect()
    for g, d in pairs.items():
        met = direct([x for h, x in leaves if h == g], d)
        own = {r.leaf: r.cluster for r in cut if r.grp == g}
        assert all((own[a] == own[b]) == (2 * h <= 0.4) for (a, b), h in met.items())


def test_ties_and_empty_tables(spark):
    leaves = spark.createDataFrame([("g", x) for x in "abcd"], "grp string, leaf string")
    same = spark.createDataFrame([("g", x, y, 1.0) for x in "abcd" for y in "abcd" if x < y], "grp string, i string, j string, d double")
    merges, roots = trees.average_link(leaves, same)
    assert merges.count() == 3 and roots.count() == 1 and {r.height for r in merges.collect()} == {0.5}
    merges, roots = trees.average_link(leaves.where("leaf = 'z'"), same.where("d > 5"))
    assert merges.count() == 0 and roots.count() == 0


def plain_distance(a, b, overlap):
    best = []
    for flipped, c in ((False, b), (True, b.reverse())):
        for s in range(-len(b) + 1, len(a)):
            at = [i for i in range(len(a)) if 0 <= i - s < len(b)]
            if len(at) > overlap or len(at) == min(len(a), len(b)):
                best.append((np.mean([np.sqrt(((a.fractions[i] - c.fractions[i - s]) ** 2).sum() / 2) for i in at]), flipped, s))
    return min(best)


def test_pair_distances(spark, monkeypatch):
    rng = np.random.default_rng(2)
    made = {f"m{i}": Motif.random(int(rng.integers(3, 12)), rng) for i in range(14)}
    rows = [("x" if i % 3 else None, k, m.fractions.tolist()) for i, (k, m) in enumerate(made.items())] + [("x", None, [[0.25] * 4]), ("x", "n", None)]
    monkeypatch.setattr(distances, "BLOCK", 3)
    got = distances.pair_distances(spark.createDataFrame(rows, "grp string, id string, fractions array<array<double>>"), overlap=4).collect()
    groups = {}
    for g, k, _ in rows[:-2]:
        groups.setdefault(g, []).append(k)
    assert sorted((r.grp or "", r.i, r.j) for r in got) == sorted((g or "", x, y) for g, ks in groups.items() for x in ks for y in ks if x < y)
    for r in got:
        d, flipped, s = plain_distance(made[r.i], made[r.j], 4)
        assert abs(r.d - d) < 1e-9 and (r.flipped, r["shift"]) == (flipped, s)


def test_fractions(spark):
    counts = spark.createDataFrame([("g", 0, "A", 3), ("g", 0, "C", 1), ("g", 0, "-", 9), ("g", 2, "T", 2), ("g", 1, "-", 4)], "k string, pos int, letter string, cnt long")
    f = trees.fractions_of(counts, "k", beta=0.0).first().fractions
    assert f == [[0.75, 0.25, 0, 0], [0.25] * 4, [0, 0, 0, 1]]
    two = trees.in_families(spark.createDataFrame([("IGHV1-2", [[1.0]])], "id string, fractions array<array<double>>"), F.substring("id", 1, 5)).collect()
    assert {r.grp for r in two} == {"IGHV1", "all"}

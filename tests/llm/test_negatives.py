"""Hard negatives against brute force: exact at every size of block and leaf, with ties, copies, odd rows and lengths."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paratope.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, region int, v string"


def brute(rows, scale=256, every=10, positives=5, k=10, low=30, high=90):
    """Rows (id, vector, label), ids unique."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], c) for i, v, c in rows if i is not None and v and c is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for a, q, own in kept:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, c) for i, v, c in kept if i != a and len(v) == len(q))
        for s, p, _ in [x for x in scored if x[2] == own][:positives]:
            fits = [(i, -t) for t, i, c in scored if c != own and low * -s <= 100 * -t <= high * -s]
            out |= {(a, p, r + 1, i, -s, t) for r, (i, t) in enumerate(fits[:k])}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12)) * 0.2
    out = [(i, (centres[rng.integers(6)] + rng.normal(size=12) * 0.1).tolist(), int(rng.integers(4))) for i in range(600)]
    out += [(i, out[7][1], i % 3) for i in range(600, 720)]  # copies of a vector under three labels
    out += [(i, (-centres[0]).tolist(), 9) for i in range(720, 724)]  # the one label with few rows
    out += [(i, rng.normal(size=5).tolist(), i % 2) for i in range(800, 830)]  # another length
    out += [(900, None, 1), (910, [], 1), (920, [0.0] * 12, 2), (930, [float("nan")] + [0.1] * 11, 2), (940, [None] + [0.1] * 11, 2), (950, out[0][1], None), (None, out[0][1], 1)]
    return out


@pytest.mark.parametrize("block,leaf", [(8192, 256), (60, 8), (25, 5)])
def test_equal_to_brute_force(spark, rows, block, leaf, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "LEAF", leaf)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    got = negatives.hard_negatives(negatives.quantised(df), F.col("id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)


def test_other_windows_and_shares(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 60)
    monkeypatch.setattr(negatives, "SHARE", 7)  # queries of a region answered by several copies of its blocks
    monkeypatch.setattr(negatives, "QUERIES", 3)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(2)
    got = negatives.hard_negatives(negatives.quantised(df), F.col("id") % 10 == 0, positives=3, negatives=4, low=-50, high=101)
    assert {tuple(r) for r in got.collect()} == brute(rows, positives=3, k=4, low=-50, high=101)


def test_repeated_ids_and_empty_tables(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows[:200] + rows[:50]], SCHEMA)
    assert {tuple(r) for r in negatives.hard_negatives(negatives.quantised(df), F.col("id") % 10 == 0).collect()} == brute(rows[:200])
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mined(none).collect() == []
    assert negatives.hard_negatives(negatives.quantised(df), F.col("id") < 0).collect() == []


def test_leaves_that_cannot_hold_better_rows_are_not_visited():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    x = np.rint(x / np.sqrt((x**2).sum(1, keepdims=True)) * 1000)
    block = negatives.Block(np.arange(4000), np.zeros(4000, np.int64), x, float((x**2).sum(1).max()))
    seen = []
    block.leaves = Watched(block.leaves, seen)
    q = x[:1]
    at, row, score = block.best(q, np.array([-1]), np.array([0]), np.array([True]), np.array([-(1 << 52)]), np.array([1 << 52]), 5)
    want = sorted(((-int(s), i) for i, s in enumerate((x @ q[0]).astype(int))))[:5]
    assert [(-int(s), int(r)) for s, r in zip(score, row)] == want
    assert len(seen) < len(block.leaves) / 2


class Watched(list):
    def __init__(self, leaves, seen):
        super().__init__(leaves)
        self.seen = seen

    def __getitem__(self, i):
        self.seen.append(i)
        return super().__getitem__(i)


def test_bounds_hold():
    rng = random.Random(2)
    g = np.random.default_rng(2)
    x = np.rint(g.normal(size=(300, 6)) * 100)
    most = float((x**2).sum(1).max())
    block = negatives.Block(np.arange(300), np.zeros(300, np.int64), x, most)
    q = x[rng.sample(range(300), 20)]
    low, high = negatives.score_bounds(q, most, block.points, block.near, block.far)
    for i, rows in enumerate(block.leaves):
        s = q @ block.x[rows].T
        assert (s.min(1) >= low[:, i]).all() and (s.max(1) <= high[:, i]).all()

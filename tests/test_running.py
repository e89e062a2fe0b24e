"""Running sums, ranks and nearest marks: equal to plain loops, and no window in one task."""

import random
from bisect import bisect

import pytest

from paratope import catalog
from paratope.functions import stats
from paratope.operators import diversity, hts
from paratope.operators.running import running_sums


def test_running_sums_split_keys_that_begin_alike(spark):
    rng = random.Random(1)
    rows = [("CAR" + "".join(rng.choice("ACDEFG") for _ in range(9)) + str(i), rng.randint(0, 5)) for i in range(3000)] + [("CARZ", None)]
    df = spark.createDataFrame(rows, "aa string, cnt long").repartition(3)
    got = diversity.cumulative(df, "aa")
    upto, want = 0, {}
    for k, n in sorted(rows):
        upto += n or 0
        want[k] = (n, upto)
    assert {r.aa: (r.cnt, r.upto) for r in got.collect()} == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [len(x) for x in running_sums(df, ["aa"], "cnt", "u").rdd.glom().collect() if x]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 3000  # tasks may read several ranges
    assert running_sums(df.where("cnt > 99"), ["aa"], "cnt", "u").collect() == []


def test_average_ranks_with_ties_and_nulls(spark):
    rng = random.Random(2)
    values = [rng.choice([None, 1.5, 2.0, 2.0, 7.25, rng.random()]) for _ in range(500)]
    got = {r.i: r.rank for r in stats.average_ranks(spark.createDataFrame(list(enumerate(values)), "i int, v double").repartition(4), "v").collect()}
    order = sorted((v is not None, v or 0) for v in values)
    for i, v in enumerate(values):
        at = [j + 1 for j, x in enumerate(order) if x == (v is not None, v or 0)]
        assert got[i] == sum(at) / len(at)


@pytest.mark.parametrize("width", [7, 50, 1 << 17])
def test_nearest_marks(spark, width):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", "c"]), rng.choice([40, rng.randint(-500, 500)])) for i in range(400)] + [(900, "none", 5), (901, "a", None)]
    marks = [(rng.choice(["a", "b"]), rng.randint(-400, 400)) for _ in range(25)] + [("c", 3), ("a", None)]
    marks += marks[:3]
    got = hts.nearest(spark.createDataFrame(rows, "id int, chrom string, pos long"), spark.createDataFrame(marks, "chrom string, mark long"), width)
    by = {c: sorted(m for d, m in marks if d == c and m is not None) for c in "abc"}
    want = {}
    for i, c, p in rows:
        if c in by and p is not None:
            j = bisect(by[c], p)
            want[i] = min(abs(p - m) for m in by[c][max(0, j - 1) : j + 1])
    assert {r.id: r.distance for r in got.collect()} == want


@pytest.mark.parametrize("name", ["w3_cumulative", "w5_average_ranks", "m22_rank_sum", "m42_nearest"])
def test_no_window_in_one_task(spark, name):
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for before, line in zip(plan.splitlines(), plan.splitlines()[1:]):
        assert not ("Exchange SinglePartition" in line and ("Window" in before or "Sort" in before))


def test_sampling_without_exploding_reads(spark):
    """Every seed draws exactly n reads; numbers drawn and richness meet the closed form on average."""
    counts = [(f"c{i:02}", n) for i, n in enumerate([1] * 20 + [2] * 10 + [5] * 6 + [40, 90])]
    df = spark.createDataFrame([*counts, ("none", 0)], "aa string, cnt long").repartition(3)
    total, n, seeds = sum(c for _, c in counts), 60, range(24)
    drawn, rich = dict.fromkeys(dict(counts), 0), []
    for s in seeds:
        rows = {r.aa: r.x for r in diversity.sampled(df, "aa", n, s).collect()}
        assert sum(rows.values()) == n and all(0 < x <= dict(counts)[k] for k, x in rows.items())
        rich.append(len(rows))
        for k, x in rows.items():
            drawn[k] += x
    want = diversity.rarefaction(df, [n]).first().expected
    assert abs(sum(rich) / len(rich) - want) < 1.5
    assert abs(drawn["c37"] / len(seeds) - 90 * n / total) < 2.5 and abs(drawn["c36"] / len(seeds) - 40 * n / total) < 2
    assert {r.aa: r.x for r in diversity.sampled(df, "aa", total, 1).collect()} == dict(counts)
    got = diversity.sampled_richness(df, "aa", n, [3, 5]).collect()
    assert [(r.seed, r.richness) for r in got] == [(3, rich[3]), (5, rich[5])]
    assert diversity.sampled_richness(df.where("cnt > 999"), "aa", 5, [1]).first().richness == 0


def test_ranks_are_even():
    import numpy as np

    rng = np.random.default_rng(1)
    seen = np.zeros(10)
    for _ in range(2000):
        r = diversity._ranks(10, 3, rng)
        assert len(set(r.tolist())) == 3
        seen[r] += 1
    assert abs(seen / 2000 - 0.3).max() < 0.05

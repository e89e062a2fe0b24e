"""Joins and unions of spans against loops, at any width of bins."""

import random

import pytest

from paratope.operators import intervals


@pytest.fixture(scope="module")
def spans():
    rng = random.Random(3)
    row = lambda i: (i, rng.choice(["x", "y"]), s := rng.choice([100, rng.randint(-200, 900)]), s + rng.choice([0, 1, rng.randint(1, 40), rng.randint(1, 40), 2500]))
    a, b = [row(i) for i in range(120)], [row(i) for i in range(90)]
    return a + [(500, None, 1, 5), (501, "x", None, 5), (502, "x", 9, 4), (503, "alone", 1, 2)], b + b[:2]


SCHEMA = "id int, chrom string, start long, end long"


@pytest.mark.parametrize("width,within", [(8, 0), (64, 7), (1 << 14, 0)])
def test_overlapping(spark, spans, width, within):
    a, b = spans
    got = intervals.overlapping(spark.createDataFrame(a, SCHEMA).repartition(3), spark.createDataFrame(b, SCHEMA).repartition(2), within, width)
    assert got.columns == ["id", "chrom", "start", "end", "b_id", "b_start", "b_end"]
    ok = lambda s, e: s is not None and s < e
    want = sorted((i, j) for i, c, s, e in a if c and ok(s, e) for j, d, t, f in b if c == d and ok(t, f) and s - within < f and t < e + within)
    assert sorted((r.id, r.b_id) for r in got.collect()) == want
    for r in intervals.span_gaps(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), within, width).collect():
        places = min(abs(p - q) for p in (r.start, r.end - 1) for q in (r.b_start, r.b_end - 1))
        assert r.gap == (0 if r.start < r.b_end and r.b_start < r.end else places)


@pytest.mark.parametrize("width,touch", [(8, True), (64, False), (1 << 14, True)])
def test_merged(spark, spans, width, touch):
    a, _ = spans
    want = []
    for c in ("x", "y", "alone"):
        own = sorted((s, e) for _, d, s, e in a if d == c and s is not None and s < e)
        for s, e in own:
            if want and want[-1][0] == c and (s <= want[-1][2] if touch else s < want[-1][2]):
                want[-1][2], want[-1][3] = max(want[-1][2], e), want[-1][3] + 1
            else:
                want.append([c, s, e, 1])
    got = intervals.merged(spark.createDataFrame(a, SCHEMA).repartition(3), touch, width)
    assert sorted(map(list, got.collect())) == sorted(want)


def test_neighbourhoods(spark):
    probes = spark.createDataFrame([("p", "AACCGGTTACGTACGTTTAA"), ("q", "ACGT")], "probe_id string, seq string")
    sites = spark.createDataFrame([("p", 4, 6), ("p", 9, 11), ("p", 17, 19), ("q", 0, 2), ("gone", 1, 2)], "probe_id string, start long, end long")
    got = sorted(map(tuple, intervals.neighbourhoods(sites, probes, 2).collect()))
    assert got == [("p", 2, 13, 2, "CCGGTTACGTA"), ("p", 15, 20, 1, "TTTAA"), ("q", 0, 4, 1, "ACGT")]
    assert intervals.merged(probes.select(probes.probe_id.alias("chrom")).where("chrom = 'z'").selectExpr("chrom", "1L AS start", "2L AS end")).collect() == []

"""The cross-validated motif classifier: an exact separator, oversampling within bounds, and fold losses equal to a plain loop."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paratope.operators import classify, em
from paratope.operators.motifs import Motif


def objective(w, b, pos, neg, c):
    return w * w / 2 + c * (sum(max(0.0, 1 - w * x - b) for x in pos) + sum(max(0.0, 1 + w * x + b) for x in neg))


def least(pos, neg, c):
    """The least objective for w >= 0: for a w the best b is at a hinge, and in w the function is convex."""
    best = lambda w: min(objective(w, b, pos, neg, c) for b in [1 - w * x for x in pos] + [-1 - w * x for x in neg])
    lo, hi = 0.0, 2000.0
    for _ in range(200):
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        if best(a) <= best(b):
            hi = b
        else:
            lo = a
    return best((lo + hi) / 2)


@pytest.mark.parametrize("apart", [0.0, 1.0, 6.0])
def test_separators_are_exact(spark, apart):
    rng = random.Random(int(apart))
    rows = []
    for g in range(6):
        n, m = rng.randint(1, 14), rng.randint(1, 14)
        rows += [(g, True, round(rng.gauss(apart, 1), rng.choice([1, 6]))) for _ in range(n)] + [(g, False, round(rng.gauss(0, 1), rng.choice([1, 6]))) for _ in range(m)]
    rows += [(98, True, 1.0), (98, False, 1.0), (99, True, 1.0), (99, True, 2.0)]
    found = classify.separators(spark.createDataFrame(rows, "model int, own boolean, score double").repartition(3), ["model"], (1e-4, 0.1, 1.0, 10.0)).collect()
    assert {r.model for r in found} == set(range(6)) and len(found) == 24
    for r in found:
        x = {k: [(s - r.mid) / r.half for g, k2, s in rows if g == r.model and k2 == k] for k in (True, False)}
        got, want = objective(r.w, -r.b, x[True], x[False], r.cost), least(x[True], x[False], r.cost)
        assert got <= want + 1e-6 * max(1.0, want), (r, got, want)


def test_oversampled_points_lie_towards_a_near_positive(spark):
    rng = random.Random(4)
    rows = [(m, i, i % 3 > 0, i % 4, rng.gauss(0, 3)) for m in range(2) for i in range(30)] + [(5, 1, True, 0, 2.0), (5, 2, False, 0, 1.0)]
    df = spark.createDataFrame(rows, "model int, probe_id int, own boolean, part int, score double").repartition(2)
    out = classify.oversampled(df, 4).collect()
    assert sorted((r.model, r.probe_id, r.score) for r in out if not r.copy) == sorted((m, i, s) for m, i, _, _, s in rows)
    for m in range(2):
        pos = {i: s for k, i, own, _, s in rows if k == m and own}
        made = [r for r in out if r.model == m and r.copy]
        assert len(made) == 3 * len(pos) and all(r.own and r.part == r.probe_id % 4 for r in made)
        for r in made:
            near = sorted((abs(s - pos[r.probe_id]), s) for i, s in pos.items() if i != r.probe_id)[:4]
            assert any(min(s, pos[r.probe_id]) - 1e-9 <= r.score <= max(s, pos[r.probe_id]) + 1e-9 for _, s in near)
    assert [r.score for r in out if r.model == 5 and r.copy] == []
    assert classify.oversampled(df, 1).count() == len(rows)


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(150):
        s = "".join(rng.choice(list("ACGT"), int(rng.integers(30, 60))))
        rows.append((i, s[:8] + "TGACTCA" + s[8:] if i < 40 and i % 5 else s))
    rows += [(900, None), (901, ""), (902, "NNNNACGTNNNN"), (903, "ACG")]
    return spark.createDataFrame(rows, "probe_id int, seq string").repartition(3), spark.createDataFrame([(i,) for i in range(40)] + [(900,)], "probe_id int"), dict(rows)


def test_fold_losses_equal_a_plain_loop(tables):
    probes, subset, seqs = tables
    hypotheses = {"good": Motif.from_text("TGACTCA"), "bad": Motif.from_text("CCCGGG")}
    betas, costs, folds = (0.5, None), (0.1, 10.0), 3
    got = {(r.hypothesis, r.beta, r.part, r.cost): r.loss for r in classify.fold_losses(probes, subset, hypotheses, folds, betas, costs).collect()}
    sample, times = classify.balanced(probes, subset, folds)
    rows = sample.collect()
    assert times == 2 and sum(r.own for r in rows) == 40 and len(rows) == 120 and {r.part for r in rows} == {0, 1, 2}
    assert set(got) == {(h, b, f, c) for h in hypotheses for b in betas for f in range(folds) for c in costs}
    spark = probes.sparkSession
    even = em.Background.even()
    model = 0
    for h, m in hypotheses.items():
        for b in betas:
            for f in range(folds):
                own = spark.createDataFrame([(r.seq,) for r in rows if r.own and r.part != f], "seq string")
                refined = m if b is None else em.em(own, {"x": m}, even, 0.75, b)["x"][0]
                scores = [(model, r.probe_id, r.own, r.part, refined.best_score(r.seq)) for r in rows if len(r.seq) >= len(m)]
                more = classify.oversampled(spark.createDataFrame(scores, "model int, probe_id int, own boolean, part int, score double"), times).collect()
                for c in costs:
                    x = [r.score for r in more if r.part != f]
                    mid, half = (max(x) + min(x)) / 2, (max(x) - min(x)) / 2
                    at = lambda r: (r.score - mid) / half  # noqa: B023, E731
                    pos, neg = ([at(r) for r in more if r.part != f and r.own == k] for k in (True, False))
                    want = least(pos, neg, c)
                    found = classify.separators(spark.createDataFrame([(0, r.own, r.score) for r in more if r.part != f], "model int, own boolean, score double"), ["model"], (c,)).first()
                    assert objective(found.w, -found.b, pos, neg, c) <= want + 1e-6 * max(1.0, want)
                    test = [r for r in more if r.part == f]
                    wrong = sum((found.w * at(r) - found.b < 0) if r.own else (found.w * at(r) - found.b > 0) for r in test)
                    assert abs(got[h, b, f, c] - wrong / len(test)) < 0.03, (h, b, f, c)
                model += 1
    best = {r.hypothesis: r for r in classify.cross_validated(spark.createDataFrame([(*k, v) for k, v in got.items()], "hypothesis string, beta double, part int, cost double, loss double")).collect()}
    assert best["good"].loss < 0.25 < best["bad"].loss


def test_no_positives(tables):
    probes, subset, _ = tables
    none = classify.fold_losses(probes, subset.where("probe_id < 0"), {"x": Motif.from_text("ACGT")}, 2, (None,), (1.0,))
    assert none.collect() == []
    assert classify.fold_losses(probes.where(F.lit(False)), subset, {"x": Motif.from_text("ACGT")}, 2, (0.5,), (1.0,)).collect() == []

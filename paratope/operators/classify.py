"""A cross-validated classifier of probes by a motif: hypotheses refined on each fold's training probes, oversampled, and separated by a
one-dimensional support vector machine, with every combination of hypothesis, pseudocount, fold and cost as rows of one table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paratope.operators.em import Background, em
from paratope.operators.motifs import Motif
from paratope.plans.shared import written

# The grid of pseudocounts and of costs, the most negatives a positive and the most positives.
BETAS = (0.05 / 0.95, 0.1 / 0.9, 0.5, 1.0, 2.0, None)  # None: the hypothesis as it is
COSTS = (1e-10, 1e-4, 1e-3, 1e-2, 0.05, 0.1, 1.0, 10.0, 100.0)
MOST_NEGATIVES = 10
MOST_POSITIVES = 2000


def balanced(probes: DataFrame, subset: DataFrame, folds: int, seed: int = 0, positives: int = MOST_POSITIVES, times: int = MOST_NEGATIVES) -> tuple[DataFrame, int]:
    """((probe_id, seq, own, part), times): the probes of the subset, ``positives`` at most, and as many others times a whole number,
    ``times`` at most, both by the least seeded hashes; with a fold (0 up) by another hash. Others with letters that aren't bases
    or without a text are left out, as are positives without a text. A classifier is fitted on this bounded sample only."""
    own = subset.select("probe_id").distinct().withColumn("own", F.lit(True))
    rows = probes.select("probe_id", F.upper("seq").alias("seq")).where("seq <> ''").join(own, "probe_id", "left").withColumn("own", F.coalesce("own", F.lit(False)))
    rows = rows.where(F.col("own") | F.col("seq").rlike("^[ACGT]+$"))
    n = rows.agg(F.count_if("own").alias("own"), F.count_if(~F.col("own")).alias("other")).first()
    mine = min(n.own, positives)
    times = min(times, n.other // mine) if mine else 0
    first = lambda c, k: rows.where(c).orderBy(F.xxhash64(F.lit(seed), "probe_id"), "probe_id").limit(k)
    both = first(F.col("own"), mine).unionByName(first(~F.col("own"), times * mine))
    return both.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 1), "probe_id"), F.lit(folds)).cast("int")), times


def best_scores(sample: DataFrame, motifs: Sequence[tuple[int, Motif]]) -> DataFrame:
    """(model, probe_id, own, part, score): the best log-likelihood ratio of each numbered motif in each probe, on either strand; probes
    that are shorter than the motif have no row."""

    def run(batches):
        for b in batches:
            ids, own, part, seqs = b.column(0), b.column(1), b.column(2), b.column(3).to_pylist()
            for model, m in motifs:
                x = np.array([m.best_score(s) for s in seqs])
                keep = pa.array(np.isfinite(x))
                n = int(np.isfinite(x).sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, model, np.int32)), *(c.filter(keep) for c in (ids, own, part)), pa.array(x[np.isfinite(x)])], names=["model", "probe_id", "own", "part", "score"])

    way = sample.schema["probe_id"].dataType.simpleString()
    spread = sample.select("probe_id", "own", "part", "seq").repartition(sample.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, f"model int, probe_id {way}, own boolean, part int, score double")


def oversampled(scores: DataFrame, times: int, seed: int = 0) -> DataFrame:
    """``scores`` with each positive ``times`` - 1 times more, moved by a random share of the way to one of its ``times`` nearest
    positives of the model (Chawla et al. 2002); shares and choices are seeded hashes. ``copy`` is 0 for the rows given.

    In order of scores the nearest lie among the ``times`` before and after a row.
    """
    rows = scores.withColumn("copy", F.lit(0))
    if times < 2:
        return rows
    order = Window.partitionBy("model").orderBy("score", "probe_id")
    beside = [f("score", k).over(order) for k in range(1, times + 1) for f in (F.lag, F.lead)]
    gaps = F.array_compact(F.transform(F.array(*beside), lambda x: x - F.col("score")))
    near = F.slice(F.array_sort(F.transform(gaps, lambda g: F.struct(F.abs(g).alias("far"), g.alias("gap")))), 1, times)
    own = scores.where("own").withColumn("near", near).where(F.size("near") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times - 1))))
    draw = lambda k: F.xxhash64(F.lit(seed + k), "model", "probe_id", "copy")
    chosen = F.element_at("near", (F.pmod(draw(0), F.size("near")) + 1).cast("int"))["gap"]
    share = F.pmod(draw(1), F.lit(1 << 30)) / float(1 << 30)
    return rows.unionByName(own.withColumn("score", F.col("score") + chosen * share).select(*rows.columns))


def separators(train: DataFrame, by: Sequence[str], costs: Sequence[float] = COSTS) -> DataFrame:
    """(by, cost, w, b, mid, half) of the support vector machine that puts positives above: the label of a score is the sign of
    w * (score - mid) / half - b, where scores are scaled to -1..1.

    Exact: with the j-th lowest positive p_j and the j-th highest negative n_j, what is left to minimise over w >= 0 once b is best is
    w^2 / 2 + cost * sum_j max(0, 2 - w (p_j - n_j)). Gaps rise with j, so between two corners 2 / gap the sum runs over the first i
    pairs, and prefix sums give its minimum there. Groups without positives, negatives or different scores have no row.
    """
    key = list(by)
    ends = train.groupBy(*key).agg(((F.max("score") + F.min("score")) / 2).alias("mid"), ((F.max("score") - F.min("score")) / 2).alias("half")).where("half > 0")
    scaled = train.join(ends, key).withColumn("x", (F.col("score") - F.col("mid")) / F.col("half"))
    rank = lambda order: F.row_number().over(Window.partitionBy(*key).orderBy(order))
    low = scaled.where("own").select(*key, "mid", "half", F.col("x").alias("p"), rank(F.asc("x")).alias("j"))
    high = scaled.where("NOT own").select(*key, F.col("x").alias("n"), rank(F.desc("x")).alias("j"))
    pairs = low.join(high, [*key, "j"]).withColumn("g", F.col("p") - F.col("n"))
    along = Window.partitionBy(*key).orderBy("j")
    # Row j stands for the stretch in which the j - 1 pairs before it are within the margin; a last row for all of them.
    size = F.max("j").over(Window.partitionBy(*key))
    stretch = pairs.withColumns({"before": F.coalesce(F.sum("g").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "pg": F.lag("g").over(along), "pp": F.lag("p").over(along), "pn": F.lag("n").over(along), "size": size})
    # The row past the last pair has what is left over on the longer side.
    nxt = lambda side, c: side.select(*key, F.col("j"), F.col(c))
    end = stretch.where("j = size").select(*key, "mid", "half", (F.col("j") + 1).alias("j"), F.lit(None).cast("double").alias("g"), (F.col("before") + F.col("g")).alias("before"), F.col("g").alias("pg"), F.col("p").alias("pp"), F.col("n").alias("pn"))
    end = end.join(nxt(low, "p"), [*key, "j"], "left").join(nxt(high, "n"), [*key, "j"], "left")
    stretch = stretch.select(*end.columns).unionByName(end)
    costs_ = F.explode(F.array(*(F.lit(float(c)) for c in costs))).alias("cost")
    tried = stretch.select("*", costs_)
    corner = lambda g: F.when(F.col(g) > 0, 2 / F.col(g))  # noqa: E731  past a gap of 0 or less there is no corner
    least = F.when(F.col("g").isNull(), F.lit(0.0)).otherwise(corner("g"))  # null: the stretch is empty, as its pair is always within
    most = F.coalesce(corner("pg"), F.lit(float("inf")))
    tried = tried.withColumn("w", F.least(F.greatest(F.col("cost") * F.col("before"), least), most)).where(least.isNotNull())
    tried = tried.withColumn("loss", F.col("w") * F.col("w") / 2 + F.col("cost") * (2 * (F.col("j") - 1) - F.col("w") * F.col("before")))
    # b lies between the hinges of the pairs on either side of the margin.
    up = F.least(*(F.coalesce(x, F.lit(float("inf"))) for x in (1 - F.col("w") * F.col("pp"), -1 - F.col("w") * F.col("n"))))
    down = F.greatest(*(F.coalesce(x, F.lit(float("-inf"))) for x in (1 - F.col("w") * F.col("p"), -1 - F.col("w") * F.col("pn"))))
    inf = float("inf")
    middle = F.when((up < inf) & (down > -inf), (up + down) / 2).when(up < inf, up).when(down > -inf, down).otherwise(0.0)
    best = tried.withColumn("b", -middle).groupBy(*key, "cost").agg(F.min_by(F.struct("w", "b", "mid", "half"), F.struct("loss", "j")).alias("s"))
    return best.select(*key, "cost", "s.w", "s.b", "s.mid", "s.half")


def losses(test: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, cost, loss): the share of test rows on the wrong side; rows on the line are right."""
    label = F.col("w") * (F.col("score") - F.col("mid")) / F.col("half") - F.col("b")
    wrong = F.when(F.col("own"), label < 0).otherwise(label > 0)
    return test.join(found, list(by)).groupBy(*by, "cost").agg((F.count_if(wrong) / F.count("*")).alias("loss"))


def fold_losses(probes: DataFrame, subset: DataFrame, hypotheses: dict[str, Motif], folds: int = 5, betas: Sequence[float | None] = BETAS, costs: Sequence[float] = COSTS, background: Background | None = None, seed: int = 0, gamma: float = 0.75) -> DataFrame:
    """(hypothesis, beta, part, cost, loss) of every combination; ``beta`` is null for a hypothesis as it is.

    For each fold the others' positives refine the hypothesis by EM (all in one search), all probes are scored, positives are
    oversampled up to the negatives' number, the other folds train and the fold is tested. Folds without a test row have none.
    """
    sample, times = balanced(probes, subset, folds, seed)
    sample = written(sample, "sample")
    background = background or Background.even()
    grid = [(h, b, f) for h in hypotheses for b in betas for f in range(folds)]
    names = {str(i): (h, b, f) for i, (h, b, f) in enumerate(grid) if b is not None}
    refined = em(sample.where("own"), {i: hypotheses[h] for i, (h, _, _) in names.items()}, background, gamma, {i: b for i, (_, b, _) in names.items()}, without={i: f for i, (_, _, f) in names.items()}) if names else {}
    models = [(i, refined[str(i)][0] if str(i) in refined else hypotheses[h]) for i, (h, _, _) in enumerate(grid)]
    spark = probes.sparkSession
    table = spark.createDataFrame([(i, h, b, f) for i, (h, b, f) in enumerate(grid)], "model int, hypothesis string, beta double, fold int")
    scores = oversampled(written(best_scores(sample, models), "scores"), times, seed).join(F.broadcast(table.select("model", "fold")), "model")
    scores = written(scores, "oversampled")
    found = separators(scores.where("part <> fold"), ["model"], costs)
    out = losses(scores.where("part = fold"), found, ["model"])
    return out.join(table, "model").select("hypothesis", "beta", F.col("fold").alias("part"), "cost", "loss")


def cross_validated(fold: DataFrame) -> DataFrame:
    """(hypothesis, beta, cost, loss) of each hypothesis's best combination by mean loss over the folds; ties by the greatest beta,
    a hypothesis as it is first, then by the least cost."""
    mean = fold.groupBy("hypothesis", "beta", "cost").agg(F.avg("loss").alias("loss"))
    first = F.row_number().over(Window.partitionBy("hypothesis").orderBy(F.round("loss", 12), F.desc_nulls_first("beta"), "cost"))
    return mean.withColumn("rn", first).where("rn = 1").drop("rn")



"""Statistics of counts and ranks. Log-factorials need ``math.lgamma``, which Spark SQL lacks, so these are pandas UDFs over the
few rows of an aggregate."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paratope.operators.running import running_sums


def log_choose(n: float, k: float) -> float:
    return -math.inf if k < 0 or k > n else math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric_tail(found: int, draws: int, marked: int, total: int) -> float:
    """Probability of at least ``found`` marked items among ``draws`` of ``total`` items of which ``marked`` are marked."""
    if found <= max(0, draws + marked - total):
        return 1.0
    all_ = log_choose(total, draws)
    return min(1.0, math.fsum(math.exp(log_choose(marked, k) + log_choose(total - marked, draws - k) - all_) for k in range(found, min(draws, marked) + 1)))


def binomial(k: int, n: int, p: float) -> float:
    if p <= 0 or p >= 1:
        return float((p <= 0 and k == 0) or (p >= 1 and k == n))
    return math.exp(log_choose(n, k) + k * math.log(p) + (n - k) * math.log1p(-p))


def binomial_tail(k: int, n: int, p: float, precision: float = 1e-12) -> float:
    """Probability of at least k successes; stops when terms no longer matter."""
    total = 0.0
    for i in range(k, n + 1):
        term = binomial(i, n, p)
        total += term
        if i > n * p and term < precision * total:
            break
    return min(1.0, total)


_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _log_chooses(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    return _lgamma(n + 1.0) - _lgamma(k + 1.0) - _lgamma(n - k + 1.0)


def _summed(first: np.ndarray, steps: np.ndarray, ratio) -> np.ndarray:
    """Sums of terms that begin with ``first`` and go on ``steps`` times, each ``ratio(j, which)`` times the one before; a sum ends
    where its terms fall and no longer matter."""
    total, term = first.copy(), first.copy()
    live, j = np.flatnonzero((steps > 0) & (first > 0)), 0
    while len(live):
        r = ratio(j, live)
        term[live] *= r
        total[live] += term[live]
        j += 1
        live = live[(steps[live] > j) & ((r > 1) | (term[live] > 1e-17 * total[live]))]
    return total


def hypergeometric_tails(found, draws, marked, total) -> np.ndarray:
    """``hypergeometric_tail`` of arrays. Above the mean terms are summed upwards, below it downwards from one."""
    k, d, m, t = (np.asarray(x, dtype=np.float64) for x in (found, draws, marked, total))
    least, most = np.maximum(0.0, d + m - t), np.minimum(d, m)
    out = np.where(k <= least, 1.0, 0.0)
    open_ = np.flatnonzero((k > least) & (k <= most))
    k, d, m, t, least, most = (x[open_] for x in (k, d, m, t, least, most))
    up = k * t >= d * m
    at = np.where(up, k, k - 1)
    first = np.exp(_log_chooses(m, at) + _log_chooses(t - m, d - at) - _log_chooses(t, d)) if len(at) else at
    ahead = lambda j, i: (m[i] - at[i] - j) * (d[i] - at[i] - j) / ((at[i] + j + 1) * (t[i] - m[i] - d[i] + at[i] + j + 1))
    back = lambda j, i: (at[i] - j) * (t[i] - m[i] - d[i] + at[i] - j) / ((m[i] - at[i] + j + 1) * (d[i] - at[i] + j + 1))
    both = _summed(first, np.where(up, most - at, at - least), lambda j, i: np.where(up[i], ahead(j, i), back(j, i)))
    out[open_] = np.clip(np.where(up, both, 1 - both), 0.0, 1.0)
    return out


def binomial_tails(k, n, p) -> np.ndarray:
    """``binomial_tail`` of arrays."""
    k, n, p = (np.asarray(x, dtype=np.float64) for x in (k, n, p))
    out = np.where((k <= 0) | ((p >= 1) & (k <= n)), 1.0, 0.0)
    open_ = np.flatnonzero((k > 0) & (k <= n) & (p > 0) & (p < 1))
    k, n, p = k[open_], n[open_], p[open_]
    up = k >= n * p
    at = np.where(up, k, k - 1)
    first = np.exp(_log_chooses(n, at) + at * np.log(p) + (n - at) * np.log1p(-p)) if len(at) else at
    odds = p / (1 - p)
    both = _summed(first, np.where(up, n - at, at), lambda j, i: np.where(up[i], (n[i] - at[i] - j) / (at[i] + j + 1) * odds[i], (at[i] - j) / (n[i] - at[i] + j + 1) / odds[i]))
    out[open_] = np.clip(np.where(up, both, 1 - both), 0.0, 1.0)
    return out


def poisson(k: int, mean: float) -> float:
    return float(k == 0) if mean <= 0 else math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))


def poisson_tail(k: int, mean: float) -> float:
    return max(0.0, 1.0 - math.fsum(poisson(i, mean) for i in range(k)))


def best_poisson(values: list[int], steps: int = 100) -> tuple[float, float]:
    """The mean of the Poisson distribution nearest to the values' shares by least squares, and the sum of squares; means are tried
    in equal steps from 0.9 times the lesser to 1.1 times the greater of the values' mean and sample variance."""
    n = len(values)
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values) / (n - 1) if n > 1 else 0.0
    lo, hi = 0.9 * min(mean, var), 1.1 * max(mean, var)
    share = [values.count(k) / n for k in range(max(values) + 2)]
    tried = [lo + (hi - lo) / steps * i for i in range(steps)]
    return min(((m, math.fsum((y - poisson(k, m)) ** 2 for k, y in enumerate(share))) for m in tried), key=lambda x: (x[1], x[0]))


def log2_sum(values: list[float]) -> float:
    """log2 of the sum of 2 to the values."""
    top = max(values)
    return top if math.isinf(top) else top + math.log2(math.fsum(2.0 ** (v - top) for v in values))


def neg_log10_of(p: float, floor: float = 1e-299) -> float:
    return abs(math.log10(max(p, floor)))


def ks_tail(d: float, n: int, m: int) -> float:
    """Tail of the two-sample Kolmogorov-Smirnov distance by its limit distribution."""
    x = d * math.sqrt(n * m / (n + m))
    x = (x + 0.12 * d + 0.11 / math.sqrt(n * m / (n + m)) * d) if d else 0.0
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * math.fsum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 101))))


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-square distribution, by the series or the continued fraction of the incomplete gamma function."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-15 * abs(total):
            n += 1
            term *= x / n
            total += term
        return 1 - front * total
    b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def _udf(fn):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([fn(int(w), int(x), int(y), int(z)) for w, x, y, z in zip(a, b, c, d, strict=True)], dtype=float)

    return run


hypergeometric_tail_udf = _udf(hypergeometric_tail)


@F.pandas_udf(T.DoubleType())
def binomial_tail_udf(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series([binomial_tail(int(a), int(b), float(c)) for a, b, c in zip(k, n, p, strict=True)], dtype=float)


@F.pandas_udf(T.DoubleType())
def normal_tail_udf(z: pd.Series) -> pd.Series:
    return z.map(normal_tail)


def neg_log10(p: Column, floor: float = 1e-299) -> Column:
    return F.abs(F.log10(F.greatest(p, F.lit(floor))))


def weighted_moments(df: DataFrame, value: str, weight: str) -> DataFrame:
    """(mean, sd) with weights, population form, in one aggregate."""
    v, w = F.col(value).cast("double"), F.col(weight).cast("double")
    s = df.agg(F.sum(w).alias("w"), F.sum(w * v).alias("x"), F.sum(w * v * v).alias("xx"))
    return s.select((F.col("x") / F.col("w")).alias("mean"), F.sqrt(F.greatest(F.col("xx") / F.col("w") - F.pow(F.col("x") / F.col("w"), 2), F.lit(0.0))).alias("sd"))


def average_ranks(df: DataFrame, value: str) -> DataFrame:
    """``df`` with a column rank, ties sharing the mean of their places.

    Only distinct values are put in order, with their numbers, as running sums by ranges of values.
    """
    counts = running_sums(df.groupBy(F.col(value).alias("__v")).agg(F.count("*").alias("__n")), ["__v"], "__n", "__upto")
    ranks = counts.select("__v", (F.col("__upto") - (F.col("__n") - 1) / 2).alias("rank"))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("__v"))).drop("__v")


def rank_sum(df: DataFrame, value: str, group: str) -> DataFrame:
    """(n1, n2, w, u, z, auc) of the Wilcoxon-Mann-Whitney test; ``group`` is true for the first sample."""
    r = average_ranks(df, value)
    s = r.agg(F.count_if(F.col(group)).alias("n1"), F.count_if(~F.col(group)).alias("n2"), F.sum(F.when(F.col(group), F.col("rank")).otherwise(0.0)).alias("w"))
    u = F.col("w") - F.col("n1") * (F.col("n1") + 1) / 2
    mean, sd = F.col("n1") * F.col("n2") / 2, F.sqrt(F.col("n1") * F.col("n2") * (F.col("n1") + F.col("n2") + 1) / 12)
    return s.select("n1", "n2", "w", u.alias("u"), F.try_divide(u - mean, sd).alias("z"), F.try_divide(u, F.col("n1") * F.col("n2")).alias("auc"))


def exact_rank_sum_tail(w: float, n1: int, n2: int) -> float:
    """Share of all choices of n1 ranks out of n1 + n2 whose sum is at least w, by counting sums (small samples)."""
    ways = {(0, 0): 1}
    for rank in range(1, n1 + n2 + 1):
        nxt = dict(ways)
        for (k, s), n in ways.items():
            if k < n1:
                nxt[k + 1, s + rank] = nxt.get((k + 1, s + rank), 0) + n
        ways = nxt
    own = {s: n for (k, s), n in ways.items() if k == n1}
    return sum(n for s, n in own.items() if s >= w) / sum(own.values())


def shapiro_wilk(x: list[float]) -> tuple[float, float]:
    """W and its p-value by Royston's approximation (1995) for 4 to 5000 values, in closed form for three."""
    x = np.sort(np.asarray(x, dtype=float))
    n = len(x)
    if n < 3:
        raise ValueError("at least three values are needed")
    if n == 3:
        w = float((x[2] - x[0]) ** 2 / 2 / ((x - x.mean()) ** 2).sum())
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    m = np.array([_normal_quantile((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    u, ss = 1 / math.sqrt(n), float(m @ m)
    # Royston's polynomials.
    a = m / math.sqrt(ss)
    last = np.polyval([-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, m[-1] / math.sqrt(ss)], u)
    if n > 5:
        prev = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, m[-2] / math.sqrt(ss)], u)
        eps = (ss - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * prev**2)
        a = m / math.sqrt(eps)
        a[[-1, -2, 0, 1]] = last, prev, -last, -prev
    else:
        eps = (ss - 2 * m[-1] ** 2) / (1 - 2 * last**2)
        a = m / math.sqrt(eps)
        a[[-1, 0]] = last, -last
    w = float((a @ x) ** 2 / ((x - x.mean()) ** 2).sum())
    if n <= 11:
        g = np.polyval([0.459, -2.273], n)
        z = (-math.log(g - math.log1p(-w)) - np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)) / math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        l = math.log(n)
        z = (math.log1p(-w) - np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], l)) / math.exp(np.polyval([0.0030302, -0.082676, -0.4803], l))
    return w, normal_tail(float(z))


def _normal_quantile(p: float) -> float:
    lo, hi = -9.0, 9.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if normal_tail(-mid) < p else (lo, mid)
    return (lo + hi) / 2

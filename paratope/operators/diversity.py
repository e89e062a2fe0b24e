"""Spectratypes, clonotypes, duplication, rarefaction, recapture and residue composition."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paratope.functions.sequences import gene
from paratope.operators.productivity import REGIONS
from paratope.operators.running import running_sums


def spectratypes(annot: DataFrame) -> DataFrame:
    """(region, len, cnt) of residue lengths; ``v`` reaches from FR1 to FR4."""
    one = lambda r, s, e: F.struct(F.lit(r).alias("region"), F.floor((F.col(e) - F.col(s) + 1) / 3).cast("int").alias("len"))
    parts = [one(r, f"{r}_start", f"{r}_end") for r in REGIONS] + [one("v", "fr1_start", "fr4_end")]
    return annot.select(F.inline(F.array(*parts))).where("len IS NOT NULL").groupBy("region", "len").agg(F.count("*").alias("cnt"))


def region_rows(seqs: DataFrame, *keep: str) -> DataFrame:
    """(keep, region, aa) for each region and for ``v``, all regions together if none is missing; empty texts are left out."""
    whole = F.when(~F.lit(False), F.concat(*REGIONS))
    full = F.when(F.least(*(F.length(r) for r in REGIONS)) > 0, whole)
    pairs = [F.struct(F.lit(r).alias("region"), F.col(r).alias("aa")) for r in REGIONS] + [F.struct(F.lit("v").alias("region"), full.alias("aa"))]
    return seqs.select(*keep, F.inline(F.array(*pairs))).where("aa IS NOT NULL AND aa <> '' AND aa <> 'None'")


def clonotypes(seqs: DataFrame) -> DataFrame:
    return region_rows(seqs).groupBy("region", "aa").agg(F.count("*").alias("cnt"))


def clonotypes_by_gene(seqs: DataFrame) -> DataFrame:
    """Clonotypes of each V gene and of all genes (gene is null) in one pass."""
    rows = region_rows(seqs, gene(F.col("germline")).alias("gene"))
    return rows.groupingSets([["gene", "region", "aa"], ["region", "aa"]], "gene", "region", "aa").agg(F.count("*").alias("cnt")).select("gene", "region", "aa", "cnt")


def region_diversity(seqs: DataFrame, by: str = "cdr3") -> DataFrame:
    """Reads of each CDR3 and how many different texts each other region has among them."""
    others = [r for r in REGIONS if r != by]
    return seqs.where(F.length(by) > 0).groupBy(by).agg(F.count("*").alias("cnt"), *(F.count_distinct(r).alias(f"n_{r}") for r in others))


def duplication(counts: DataFrame, key: str = "region") -> DataFrame:
    """(key, times, share): clonotypes seen exactly 1..9 times, and reads in clonotypes seen at least 10, 20, ... times, over all
    reads, for the ticks of the duplication curve."""
    freq = counts.groupBy(key, F.col("cnt").alias("f")).agg(F.count("*").alias("k"))
    total = freq.groupBy(key).agg(F.sum(F.col("f") * F.col("k")).alias("total"))
    low = freq.where("f < 10").select(key, F.col("f").cast("double").alias("times"), F.col("k").cast("double").alias("n"))
    ticks = [10 + i * (10000 - 10) / 99 for i in range(100)]
    # Few frequencies, a hundred ticks: the ticks are exploded beside the frequencies and summed at once.
    high = freq.select(key, "f", "k", F.explode(F.array(*map(F.lit, ticks))).alias("times")).groupBy(key, "times").agg(F.sum(F.when(F.col("f") >= F.col("times"), F.col("f") * F.col("k")).otherwise(0)).cast("double").alias("n"))
    return low.unionByName(high).join(total, key).select(key, F.round("times", 6).alias("times"), F.round(F.col("n") / F.col("total"), 9).alias("share"))


def ticks(total: int, first: int = 10, factor: float = 1.5) -> list[int]:
    """Sample sizes from ``first`` on, each ``factor`` times the one before, and the total."""
    out, x = [], first
    while x < total:
        out.append(x)
        x = int(x * factor)
    return [*out, total]


@F.pandas_udf(T.DoubleType())
def log_choose(n: pd.Series, k: pd.Series) -> pd.Series:
    lg = math.lgamma
    return pd.Series([float("-inf") if b < 0 or b > a else lg(a + 1) - lg(b + 1) - lg(a - b + 1) for a, b in zip(n, k, strict=True)])


def rarefaction(counts: DataFrame, sizes: list[int]) -> DataFrame:
    """(n, expected): expected number of different clonotypes in n reads drawn without replacement, in closed form.

    Clonotypes are first grouped by how often they occur, so the work follows the number of different frequencies.
    """
    freq = counts.groupBy(F.col("cnt").cast("long").alias("f")).agg(F.count("*").alias("k"))
    total = counts.agg(F.sum("cnt").cast("long").alias("total"))
    rows = freq.crossJoin(F.broadcast(total)).select("f", "k", "total", F.explode(F.array(*(F.lit(int(s)).cast("long") for s in sizes))).alias("n")).where("n <= total")
    missed = F.exp(log_choose(F.col("total") - F.col("f"), F.col("n")) - log_choose(F.col("total"), F.col("n")))
    return rows.groupBy("n").agg(F.round(F.sum(F.col("k") * (1 - missed)), 6).alias("expected"))


def recapture(counts: DataFrame, sizes: list[int]) -> DataFrame:
    """(n, pct): percentage of n draws from the unique clonotypes that an earlier n draws, with replacement, are expected to hold."""
    unique = counts.agg(F.count("*").cast("double").alias("u"))
    return unique.select(F.explode(F.array(*(F.lit(int(s)).cast("long") for s in sizes))).alias("n"), "u").select("n", F.round(100 * (1 - F.pow(1 - 1 / F.col("u"), F.col("n"))), 6).alias("pct"))


def weighted_recapture(counts: DataFrame, sizes: list[int]) -> DataFrame:
    """(n, pct): expected percentage of the clonotypes in n reads, drawn with replacement, that n other reads hold as well."""
    freq = counts.groupBy(F.col("cnt").cast("long").alias("f")).agg(F.count("*").alias("k"))
    total = counts.agg(F.sum("cnt").cast("double").alias("total"))
    rows = freq.crossJoin(F.broadcast(total)).select("f", "k", "total", F.explode(F.array(*(F.lit(int(s)).cast("long") for s in sizes))).alias("n"))
    q = 1 - F.pow(1 - F.col("f") / F.col("total"), F.col("n"))
    return rows.groupBy("n").agg(F.round(100 * F.sum(F.col("k") * q * q) / F.sum(F.col("k") * q), 6).alias("pct"))


def weighted_sample(counts: DataFrame, n: int, weight: str = "cnt", seed: int = 0) -> DataFrame:
    """n rows drawn without replacement with chances in proportion to a weight (Efraimidis and Spirakis), the same on every run."""
    key = [c for c in counts.columns if c != weight]
    u = (F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return counts.withColumn("__k", -F.log(u) / F.col(weight)).orderBy("__k", *key).limit(n).drop("__k")


# Regions reported together.
GROUPS = {"cdr": ["cdr1", "cdr2", "cdr3"], "fr": ["fr1", "fr2", "fr3", "fr4"], "cdr_v": ["cdr1", "cdr2", "cdr3", "v"]}


def in_groups(by_region: DataFrame) -> DataFrame:
    """Rows of a table by region, once for each group that its region is in, with a column ``grp``."""
    names = F.array_compact(F.array(*(F.when(F.col("region").isin(r), g) for g, r in GROUPS.items())))
    return by_region.select(F.explode(names).alias("grp"), *by_region.columns)


def region_recapture(counts: DataFrame, sizes: list[int]) -> DataFrame:
    """``recapture`` of each region: (region, n, pct)."""
    unique = counts.groupBy("region").agg(F.count("*").cast("double").alias("u"))
    rows = unique.select("region", "u", F.explode(F.array(*(F.lit(int(s)).cast("long") for s in sizes))).alias("n"))
    return rows.select("region", "n", F.round(100 * (1 - F.pow(1 - 1 / F.col("u"), F.col("n"))), 6).alias("pct"))


def region_rarefaction(counts: DataFrame) -> DataFrame:
    """``rarefaction`` of each region up to its total: (region, n, expected)."""
    freq = counts.groupBy("region", F.col("cnt").cast("long").alias("f")).agg(F.count("*").alias("k"))
    total = freq.groupBy("region").agg(F.sum(F.col("f") * F.col("k")).alias("total"))
    every = F.array(*(F.lit(t).cast("long") for t in ticks(10**15)))
    sized = total.select("region", "total", F.explode(F.array_union(F.filter(every, lambda x: x < F.col("total")), F.array("total"))).alias("n"))
    rows = freq.join(F.broadcast(sized), "region")
    missed = F.exp(log_choose(F.col("total") - F.col("f"), F.col("n")) - log_choose(F.col("total"), F.col("n")))
    return rows.groupBy("region", "n").agg(F.round(F.sum(F.col("k") * (1 - missed)), 6).alias("expected"))


def random_sequences(spark, n: int, length: int, background: dict[str, float], seed: int = 0) -> DataFrame:
    """(read_id, seq): n sequences of bases drawn by a background, the same on every run, made where they are needed."""
    cuts, total = [], 0.0
    for b in "ACGT":
        total += background[b]
        cuts.append((b, total))

    def letter(i):
        u = F.pmod(F.xxhash64(F.lit(seed), "id", i), F.lit(1 << 30)) / float(1 << 30)
        out = F.lit(cuts[-1][0])
        for b, top in reversed(cuts[:-1]):
            out = F.when(u < top / total, b).otherwise(out)
        return out

    return spark.range(n).select(F.col("id").alias("read_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(length)), letter), "").alias("seq"))


def planted(seqs: DataFrame, word: str, share: float = 1.0, seed: int = 0) -> DataFrame:
    """``seqs`` with a word put at a random place of a share of them."""
    u = F.pmod(F.xxhash64(F.lit(seed), "read_id"), F.lit(1 << 30)) / float(1 << 30)
    at = F.pmod(F.xxhash64(F.lit(seed + 1), "read_id"), F.greatest(F.length("seq") - len(word) + 1, F.lit(1))).cast("int")
    return seqs.withColumn("seq", F.when((u < share) & (F.length("seq") >= len(word)), F.overlay("seq", F.lit(word), at + 1)).otherwise(F.col("seq")))


def thinned(counts: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """(key, x): how many of a clonotype's cnt reads are chosen when each is by itself with a chance ``share``; seeded by the key."""

    @F.pandas_udf(T.LongType())
    def draw(h: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([int(np.random.default_rng(s & 0xFFFFFFFFFFFFFFFF).binomial(c, share)) for s, c in zip(h, n, strict=True)], dtype="int64")

    return counts.select(key, draw(F.xxhash64(F.lit(seed), key), F.col("cnt").cast("long")).alias("x")).where("x > 0")


def sampled(counts: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """(key, x): n reads drawn without replacement from clonotypes (key, cnt), as numbers by clonotype; all of them if n is more.

    No read is a row of its own. Each read is first chosen with a chance a little over n of all, which makes every set of the size
    that results as likely as another. Then as many of the chosen as are too many, a few times the square root of n, are drawn by
    their rank among the chosen in key order, and taken off where running sums say they lie. Too few chosen: once more with
    another seed. The driver holds the ranks that are taken off.
    """
    total = int(counts.agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0])
    if n >= total:
        return counts.where("cnt > 0").select(key, F.col("cnt").cast("long").alias("x"))
    again = 0
    while True:
        share = min(1.0, (n + 5 * math.sqrt(n) + 5) / total)
        got = running_sums(thinned(counts, key, share, seed + 1_000_003 * again), [key], "x", "upto")
        many = int(got.agg(F.coalesce(F.sum("x"), F.lit(0))).first()[0])
        if many >= n:
            break
        again += 1
    off = _ranks(many, many - n, np.random.default_rng(seed))
    shared = counts.sparkSession.sparkContext.broadcast(off)

    @F.pandas_udf(T.LongType())
    def taken(x: pd.Series, upto: pd.Series) -> pd.Series:
        at = shared.value
        return pd.Series(np.searchsorted(at, upto.to_numpy()) - np.searchsorted(at, (upto - x).to_numpy()), dtype="int64")

    return got.select(key, (F.col("x") - taken("x", "upto")).alias("x")).where("x > 0")


def _ranks(total: int, n: int, rng: np.random.Generator) -> np.ndarray:
    """n different numbers below ``total``, in order, every set as likely as another (Floyd 1987)."""
    out: set[int] = set()
    for top in range(total - n, total):
        x = int(rng.integers(top + 1))
        out.add(top if x in out else x)
    return np.sort(np.array(list(out), dtype=np.int64))


def sampled_richness(counts: DataFrame, key: str, n: int, seeds: list[int]) -> DataFrame:
    """(seed, richness): different clonotypes among n reads drawn without replacement, for each seed; the same on every run."""
    out = None
    for s in seeds:
        one = sampled(counts, key, n, s).agg(F.count("*").alias("richness")).select(F.lit(s).alias("seed"), "richness")
        out = one if out is None else out.unionByName(one)
    return out


def composition(counts: DataFrame, places: int = 30) -> DataFrame:
    """(position, aa, weight) over the first residues of clonotypes, weighted by reads."""
    return counts.select(F.posexplode(F.split("aa", "")).alias("position", "letter"), "cnt").where((F.col("position") < places) & (F.col("letter") != "")).groupBy("position", F.col("letter").alias("aa")).agg(F.sum("cnt").alias("weight"))


def logo_fractions(comp: DataFrame, least: float = 0.01, keep_all: bool = False) -> DataFrame:
    """Residue shares at each position; positions with under ``least`` of the largest position's weight go."""
    w = comp.withColumn("total", F.sum("weight").over(Window.partitionBy("position")))
    most = comp.groupBy("position").agg(F.sum("weight").alias("t")).agg(F.max("t").alias("most"))
    w = w.crossJoin(F.broadcast(most))
    if not keep_all:
        w = w.where(F.col("total") >= least * F.col("most"))
    return w.select("position", "aa", F.round(F.col("weight") / F.col("total"), 9).alias("fraction"))


def cumulative(counts: DataFrame, key: str) -> DataFrame:
    """Running weights (cnt) of values in key order."""
    return running_sums(counts, [key], "cnt", "upto")

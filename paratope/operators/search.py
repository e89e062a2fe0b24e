"""Enrichment of motif sites among a subset of probes: site counts, tests on them, thresholds, and a table of all metrics.

Counts and scores are taken once for each probe; every test then needs one aggregate, a row or a small histogram.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.functions.sequences import canonical
from paratope.functions.stats import binomial_tail, hypergeometric_tail, ks_tail
from paratope.operators.motif_table import chi2_classes
from paratope.operators.motifs import Motif, kmer_counts
from paratope.operators.similar import removed

BINS = (0, 1, 2, 3, 4, 5)  # lower bounds of the classes of site counts
STEPS = 1000  # classes of score ratios in ``ks``


def site_counter(motif: Motif, factor: float = 0.7, overlapping: bool = False):
    """A pandas UDF: places on either strand that score at least ``factor`` of the best; those that begin inside an earlier one
    don't count."""
    cut = factor * motif.best

    @F.pandas_udf("int")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([len(motif.starts(x, cut) if overlapping else motif.separate_starts(x, cut)) if x else 0 for x in s], dtype="int32")

    return run


def site_counts(probes: DataFrame, subset: DataFrame, motif: Motif, factor: float = 0.7, omit: DataFrame | None = None) -> DataFrame:
    """(own, bases, n): for each probe whether it is in the subset, its length and its sites; probes in ``omit`` are left out."""
    own = subset.select("probe_id").distinct().withColumn("own", F.lit(True))
    if omit is not None:
        probes = probes.join(omit.select("probe_id"), "probe_id", "left_anti")
    return probes.join(own, "probe_id", "left").select(F.coalesce("own", F.lit(False)).alias("own"), F.length("seq").alias("bases"), site_counter(motif, factor)("seq").alias("n"))


def histogram(counts: DataFrame) -> pd.DataFrame:
    """(own, n, probes, bases): a row for each number of sites, on the driver."""
    return counts.groupBy("own", "n").agg(F.count("*").alias("probes"), F.sum("bases").alias("bases")).toPandas()


def _sites(h: pd.DataFrame, cap: float = math.inf) -> tuple[int, int]:
    """Sites in the subset and in all probes, of a probe at most ``cap``."""
    sites = h["n"].clip(upper=cap) * h["probes"]
    return int(sites[h["own"]].sum()), int(sites.sum())


def _probes(h: pd.DataFrame, column: str = "probes") -> tuple[int, int]:
    return int(h.loc[h["own"], column].sum()), int(h[column].sum())


def by_probe(h: pd.DataFrame) -> float:
    """Hypergeometric tail of the probes with a site."""
    (found, marked), (draws, total) = _sites(h, 1), _probes(h)
    return hypergeometric_tail(found, draws, marked, total) if found else 1.0


def by_site(h: pd.DataFrame, cap: int = 1) -> float:
    """As ``by_probe`` on sites, at most ``cap`` a probe, with probes as draws; marked sites are taken to be no more than probes."""
    (found, marked), (draws, total) = _sites(h, cap), _probes(h)
    return hypergeometric_tail(min(found, draws), draws, min(marked, total), total) if found else 1.0


def by_repeated_site(h: pd.DataFrame, k: int = 2) -> float:
    """Each probe counts k times, with up to k sites."""
    (found, marked), (draws, total) = _sites(h, k), _probes(h)
    return hypergeometric_tail(found, k * draws, marked, k * total) if found else 1.0


def by_base(h: pd.DataFrame) -> float:
    """Hypergeometric tail of sites with bases as draws."""
    (found, marked), (draws, total) = _sites(h), _probes(h, "bases")
    return hypergeometric_tail(found, draws, marked, total) if found else 1.0


def over_represented(h: pd.DataFrame, cap: int = 4) -> float:
    """Binomial tail of the subset's sites, at most ``cap`` a probe, among all, expected by its share of the bases."""
    (found, marked), (draws, total) = _sites(h, cap), _probes(h, "bases")
    return binomial_tail(found, marked, draws / total) if found else 1.0


def share_with_site(h: pd.DataFrame) -> float:
    found, draws = _sites(h, 1)[0], _probes(h)[0]
    return found / draws if draws else 0.0


def chi2(h: pd.DataFrame, bins: tuple[int, ...] = BINS) -> float:
    """Chi-square tail of the subset's classes of site counts against those of all probes (``chi2_classes``)."""
    place = h["n"].map(lambda n: sum(n >= b for b in bins) - 1)
    seen, every = ([float(x.loc[place == i, "probes"].sum()) for i in range(len(bins))] for x in (h[h["own"]], h))
    return chi2_classes(seen, every)


def mncp(h: pd.DataFrame) -> float:
    """Mean normalised conditional probability (Clarke and Granek 2003): over the subset's probes, the mean share of the subset with
    at least as many sites, over that share of all probes."""
    own, total = _probes(h)
    if not own:
        return 1.0
    out = 0.0
    for n, probes in h.loc[h["own"], ["n", "probes"]].itertuples(index=False):
        up = h["n"] >= n
        out += probes * (h.loc[up & h["own"], "probes"].sum() / own) / (h.loc[up, "probes"].sum() / total)
    return out / own


def roc_auc(h: pd.DataFrame) -> float:
    """The share of pairs of a subset's probe and another in which the former has more sites, ties counting half."""
    a, b = h[h["own"]], h[~h["own"]]
    pairs = a["probes"].sum() * b["probes"].sum()
    if not pairs:
        return 0.5
    return float(sum(p * (b.loc[b["n"] < n, "probes"].sum() + b.loc[b["n"] == n, "probes"].sum() / 2) for n, p in a[["n", "probes"]].itertuples(index=False)) / pairs)


METRICS: dict[str, Callable[[pd.DataFrame], float]] = {
    "probe": by_probe, "site": by_site, "repeated_site": by_repeated_site, "base": by_base, "over_represented": over_represented,
    "share": share_with_site, "chi2": chi2, "mncp": mncp, "roc_auc": roc_auc,
}


def evaluate(probes: DataFrame, subset: DataFrame, motifs: dict[str, Motif], metrics: tuple[str, ...] = tuple(METRICS), factor: float = 0.7) -> DataFrame:
    """(motif, metric, value) of some motifs, each in one pass over the probes."""
    out = []
    for name, motif in motifs.items():
        h = histogram(site_counts(probes, subset, motif, factor))
        out += [(name, m, float(METRICS[m](h))) for m in metrics]
    return probes.sparkSession.createDataFrame(out, "motif string, metric string, value double")


def score_ratios(probes: DataFrame, subset: DataFrame, motif: Motif) -> DataFrame:
    """(own, ratio): each probe's best score as a share of the motif's best."""
    best = motif.best

    @F.pandas_udf("double")
    def ratio(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([motif.best_score(x) / best if x else float("-inf") for x in s], dtype=float)

    own = subset.select("probe_id").distinct().withColumn("own", F.lit(True))
    return probes.join(own, "probe_id", "left").select(F.coalesce("own", F.lit(False)).alias("own"), ratio("seq").alias("ratio"))


def best_threshold(ratios: DataFrame) -> tuple[float, float]:
    """The share of the best score at which the subset's enrichment is strongest, and its hypergeometric tail: tenths around one
    half first, then hundredths around the best of these. Two aggregates in all."""
    best, least = 0.5, 1.0
    for step in (0.1, 0.01):
        cuts = [best + step * i for i in range(-5, 5)]
        sums = [F.count_if(F.col("own") & (F.col("ratio") > c)).alias(f"f{i}") for i, c in enumerate(cuts)] + [F.count_if(F.col("ratio") > c).alias(f"m{i}") for i, c in enumerate(cuts)]
        row = ratios.agg(F.count_if("own").alias("draws"), F.count("*").alias("total"), *sums).first()
        for i, c in enumerate(cuts):
            p = hypergeometric_tail(row[f"f{i}"], row.draws, row[f"m{i}"], row.total) if row[f"f{i}"] else 1.0
            if p < least:
                best, least = c, p
    return best, least


def ks(ratios: DataFrame) -> tuple[float, float]:
    """Kolmogorov-Smirnov distance of the subset's score ratios from those of all probes, in thousandths, and its tail."""
    h = ratios.groupBy(F.floor(F.greatest("ratio", F.lit(-4.0)) * STEPS).alias("x")).agg(F.count("*").alias("all"), F.count_if("own").alias("own")).toPandas().sort_values("x")
    n, m = int(h["all"].sum()), int(h["own"].sum())
    if not n or not m:
        return 0.0, 1.0
    d = float((h["all"].cumsum() / n - h["own"].cumsum() / m).abs().max())
    return d, ks_tail(d, n, m)


def frequent_kmers(seqs: DataFrame, k: int, share: float = 0.1, letters: int = 5, seq: str = "seq") -> DataFrame:
    """(kmer, cnt) of canonical k-mers with at least ``letters`` bases that occur more than twice and more often than there are
    sequences times ``share``."""
    total = seqs.agg(F.greatest(F.lit(2.0), F.count("*") * share).alias("__least"))
    counts = kmer_counts(seqs, k, seq).groupBy(canonical(F.col("w")).alias("kmer")).agg(F.sum("cnt").alias("cnt"))
    return counts.crossJoin(F.broadcast(total)).where((F.col("cnt") > F.col("__least")) & (F.length(F.replace("kmer", F.lit("N"), F.lit(""))) >= letters)).select("kmer", "cnt")


def similar_probes(probes: DataFrame, matches: DataFrame) -> DataFrame:
    """``probes`` (probe_id, length) without those that a longer one of the list, or one as long, is similar to, as
    ``similar.without_similar`` decides it. ``matches`` is (probe_id, other, length): who is similar to whom, and the other's length."""
    own = probes.select(F.col("probe_id").alias("p"), F.col("length").alias("size"))
    here = matches.select(F.col("probe_id").alias("p"), F.col("other").alias("q"), "length").join(own, "p").join(probes.select(F.col("probe_id").alias("q")), "q", "left_semi")
    links = here.where("p <> q AND length >= size").select("p", "q").distinct()
    return probes.join(removed(links).withColumnRenamed("p", "probe_id"), "probe_id", "left_anti")

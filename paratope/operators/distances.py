"""Distances between motifs: of one width, over a range of aligned places, and least over all alignments.

Fractions are ``places x 4`` arrays. A range metric takes two motifs and the places of each that lie on one another.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.functions.stats import binomial_tail, hypergeometric_tail, neg_log10_of
from paratope.operators.motifs import FLIP, Motif


# ---------------------------------------------------------------- one width
def _same_width(a: Motif, b: Motif) -> None:
    if len(a) != len(b):
        raise ValueError("the motifs differ in width")


def columns(a: Motif, b: Motif) -> np.ndarray:
    """Distance of each place, 0 for equal fractions and 1 for two different sure bases."""
    _same_width(a, b)
    return np.sqrt(((a.fractions - b.fractions) ** 2).sum(1) / 2)


def euclidean(a: Motif, b: Motif) -> float:
    _same_width(a, b)
    return float(np.sqrt(((a.fractions - b.fractions) ** 2).sum()))


def mean_distance(a: Motif, b: Motif) -> float:
    return float(columns(a, b).mean())


def informative(m: Motif, least: float = 0.01) -> np.ndarray:
    """Places where some base's fraction differs from the background by ``least`` or more."""
    return (np.abs(m.fractions - m.background) >= least).any(1)


def masked_distance(a: Motif, b: Motif) -> float:
    """Mean distance over the places where b isn't background; infinite if b is nothing else."""
    keep = informative(b)
    return float(columns(a, b)[keep].mean()) if keep.any() else math.inf


def weighted_distance(a: Motif, b: Motif) -> float:
    """Mean distance weighted by b's information; 1 if no place of b has a tenth of a bit."""
    if b.bits.max() < 0.1:
        return 1.0
    return float((columns(a, b) * b.bits).sum() / b.bits.sum())


def directed_divergence(a: Motif, b: Motif) -> float:
    """Kullback-Leibler divergence of a from b in bits per place, over the places where b isn't background."""
    _same_width(a, b)
    keep = informative(b)
    p, q = np.maximum(a.fractions[keep], 1e-9), np.maximum(b.fractions[keep], 1e-9)
    return float((p * np.log2(p / q)).sum() / keep.sum()) if keep.any() else math.inf


def farthest(m: Motif) -> float:
    """The largest Euclidean distance that any motif can have: every place sure of the base that is rarest here."""
    other = np.zeros_like(m.fractions)
    other[np.arange(len(m)), m.fractions.argmin(1)] = 1
    return float(np.sqrt(((m.fractions - other) ** 2).sum()))


SAME_WIDTH = {"euclidean": euclidean, "mean": mean_distance, "masked": masked_distance, "weighted": weighted_distance, "divergence": directed_divergence}


# ---------------------------------------------------------------- ranges of places
def range_mean(a: Motif, b: Motif, i: np.ndarray, j: np.ndarray) -> float:
    return float(np.sqrt(((a.fractions[i] - b.fractions[j]) ** 2).sum(1) / 2).mean())


def common_bits(a: Motif, b: Motif, i: np.ndarray, j: np.ndarray, penalty: float = 0.0) -> float:
    """Bits that both motifs share over the range: of each base the lesser cross information, at least ``penalty``; a place never
    counts below 0."""
    p, q, bg = np.maximum(a.fractions[i], 1e-12), np.maximum(b.fractions[j], 1e-12), a.background
    shared = np.minimum(q * np.log2(p / bg), p * np.log2(q / bg))
    return float(np.maximum(0, np.maximum(penalty, shared).sum(1)).sum())


def range_common_bits(a, b, i, j, penalty: float = 0.0) -> float:
    return -common_bits(a, b, i, j, penalty)


def with_penalty(penalty: float) -> Callable:
    """``range_common_bits`` with a penalty for bases that only one motif favours."""
    return lambda a, b, i, j: range_common_bits(a, b, i, j, penalty)


def range_scaled_bits(a, b, i, j) -> float:
    """2 less the shared bits per place of the wider motif: 0 for two equal sure motifs under uniform background."""
    return 2 - common_bits(a, b, i, j) / max(len(a), len(b))


def range_product(a: Motif, b: Motif, i: np.ndarray, j: np.ndarray) -> float:
    return -float((a.fractions[i] * b.fractions[j]).sum())


def range_scaled_product(a, b, i, j) -> float:
    return range_product(a, b, i, j) / max(-range_product(a, a, i, i), -range_product(b, b, j, j))


def range_entropy(a: Motif, b: Motif, i: np.ndarray, j: np.ndarray) -> float:
    """Symmetric divergence over the range for each bit of information there; 1000 where there is none."""
    p, q = np.maximum(a.fractions[i], 1e-12), np.maximum(b.fractions[j], 1e-12)
    bits = float(a.bits[i].sum() + b.bits[j].sum())
    return float((p * np.log2(p / q) + q * np.log2(q / p)).sum()) / bits if bits > 0 else 1000.0


def range_mismatches(a: Motif, b: Motif, i: np.ndarray, j: np.ndarray) -> float:
    """Less the expected number of mismatches of a word of each."""
    return -float((a.fractions[i] * (1 - b.fractions[j])).sum())


RANGES = {
    "mean": range_mean, "common_bits": range_common_bits, "scaled_bits": range_scaled_bits, "product": range_product,
    "scaled_product": range_scaled_product, "entropy": range_entropy, "mismatches": range_mismatches,
}


# ---------------------------------------------------------------- alignments
def window_distance(a: Motif, b: Motif, width: int = 5, distance: Callable[[Motif, Motif], float] = mean_distance) -> float:
    """The least distance of any ``width`` places of a to any of b or its reverse complement."""
    if len(a) > len(b):
        a, b = b, a
    parts = lambda m: [m.part(s, s + width) for s in range(len(m) - width + 1)]
    return min((distance(x, y) for x in parts(a) for z in (b, b.reverse()) for y in parts(z)), default=math.inf)


def overlap_distance(a: Motif, b: Motif, overlap: int = 5, distance: Callable[[Motif, Motif], float] = mean_distance) -> float:
    """The least distance of the common places over all shifts that leave ``overlap`` of them, on either strand."""
    best = math.inf
    for c in (b, b.reverse()):
        for shift in range(overlap - len(c), len(a) - overlap + 1):
            lo, hi = max(0, shift), min(len(a), shift + len(c))
            if hi - lo >= overlap:
                best = min(best, distance(a.part(lo, hi), c.part(lo - shift, hi - shift)))
    return best


def _diagonal_means(a: Motif, b: Motif) -> np.ndarray:
    """``range_mean`` at every shift of b from 1 - len(b) to len(a) - 1: means along the diagonals of the places' distances."""
    each = np.sqrt(((a.fractions[:, None, :] - b.fractions[None, :, :]) ** 2).sum(2) / 2)
    at = (np.arange(len(a))[:, None] - np.arange(len(b))[None, :] + len(b) - 1).ravel()
    return np.bincount(at, weights=each.ravel()) / np.bincount(at)


def overhang_distance(a: Motif, b: Motif, overlap: int = 6, metric: Callable = range_mean) -> tuple[float, int, bool]:
    """The least range metric over all shifts of b, or of its reverse complement, against a that leave more than ``overlap`` places in
    common or lay the narrower one wholly on the other; with that shift and whether b is reversed. Of equal ones the forward
    strand's is taken, and the least shift."""
    shift = np.arange(1 - len(b), len(a))
    common = np.minimum(len(a), shift + len(b)) - np.maximum(0, shift)
    shift = shift[(common > overlap) | (common == min(len(a), len(b)))]

    def at(c: Motif) -> np.ndarray:
        if metric is range_mean:
            return _diagonal_means(a, c)[shift + len(c) - 1]
        places = (np.arange(max(0, s), min(len(a), s + len(c))) for s in shift.tolist())
        return np.array([metric(a, c, i, i - s) for s, i in zip(shift.tolist(), places, strict=True)])

    both = np.concatenate([at(b), at(b.reverse())])
    k = int((both <= both.min() + 1e-12).argmax())
    return float(both[k]), int(shift[k % len(shift)]), k >= len(shift)


def _both_strands(words: list[str]) -> set[str]:
    return {*words, *(w.translate(FLIP)[::-1] for w in words)}


def overlap_probability(a: Motif, b: Motif, factor: float = 0.7) -> float:
    """Hypergeometric tail of the words of the wider motif, with a free place on either side, that hold a word of the narrower."""
    wide, narrow = (a, b) if len(a) >= len(b) else (b, a)
    wide = wide.part(-1, len(wide) + 1)
    long, short = (_both_strands([w for w, _ in m.best_words(factor * m.best)]) for m in (wide, narrow))
    held = sum(any(s in w or s in w.translate(FLIP)[::-1] for s in short) for w in long)
    return hypergeometric_tail(held, len(short) * 4 ** (len(wide) - len(narrow)), len(long), 4 ** len(wide)) if held else 1.0


def word_frequency(m: Motif, width: int, factor: float = 0.7) -> float:
    """The share of all words of ``width`` uniform bases that hold a place of the motif above the threshold, taking places and
    strands as independent."""
    share = len(_both_strands([w for w, _ in m.best_words(factor * m.best)])) / 4.0 ** len(m)
    return 1 - (1 - share) ** max(0, width - len(m) + 1)


def overlap_binomial(a: Motif, b: Motif, factor: float = 0.7) -> float:
    """As ``overlap_probability``, by the binomial tail."""
    wide, narrow = (a, b) if len(a) >= len(b) else (b, a)
    wide = wide.part(-1, len(wide) + 1)
    words = _both_strands([w for w, _ in wide.best_words(factor * wide.best)])
    held = sum(narrow.best_score(w) > factor * narrow.best for w in words)
    return binomial_tail(held, len(words), word_frequency(narrow, len(wide), factor)) if held else 1.0


def overlap_score(a: Motif, b: Motif, factor: float = 0.7, binomial: bool = False) -> float:
    return neg_log10_of((overlap_binomial if binomial else overlap_probability)(a, b, factor))


# ---------------------------------------------------------------- as a table
BLOCK = 128  # motifs of a group that a task holds of either side


def pair_distances(motifs: DataFrame, metric: str = "mean", overlap: int = 6) -> DataFrame:
    """(grp, i, j, d, shift, flipped) of all pairs i < j within each group of a table (grp, id, fractions array<array<double>>) under
    uniform background.

    A group's motifs are dealt to blocks of about BLOCK and each two blocks meet in a task, so no task holds a whole group. Ids are
    unique within a group; null ones and null fractions are left out.
    """
    rows = motifs.where("id IS NOT NULL AND fractions IS NOT NULL").select("grp", "id", "fractions")
    blocks = rows.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).withColumnRenamed("grp", "__g")
    dealt = rows.join(blocks, F.col("grp").eqNullSafe(F.col("__g"))).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = dealt.select("grp", "id", "fractions", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    kind, way = motifs.schema["grp"].dataType.simpleString(), motifs.schema["id"].dataType.simpleString()

    def run(f):
        f = f.sort_values("id")
        made = [Motif(np.array([list(r) for r in x]), np.full(4, 0.25)) for x in f["fractions"]]
        ids, own, p, q = f["id"].tolist(), f["own"].tolist(), int(f["p"].iloc[0]), int(f["q"].iloc[0])
        out = [(ids[x], ids[y], *overhang_distance(made[x], made[y], overlap, RANGES[metric])) for x in range(len(f)) for y in range(x + 1, len(f)) if p == q or own[x] != own[y]]
        got = pd.DataFrame(out, columns=["i", "j", "d", "shift", "flipped"])
        got.insert(0, "grp", f["grp"].iloc[0])
        return got

    return met.groupBy("grp", "p", "q").applyInPandas(run, f"grp {kind}, i {way}, j {way}, d double, shift int, flipped boolean")

"""Motif tools without Spark: distances, scans, word generators, candidates, selectors and statistics."""

import math

import numpy as np
import pandas as pd
import pytest

from paratope.functions import stats, words
from paratope.operators import candidates, cluster, distances, search
from paratope.operators.motifs import UNIFORM, Motif
from paratope.plans import sinks
from paratope.sources import config, programs

A, B = Motif.from_text("TGASTCA"), Motif.from_text("TGACTCA")


def test_words():
    assert words.reverse("ACGW") == "WCGT" and words.unique_words(2) == ["AA", "AC", "AG", "AT", "CA", "CC", "CG", "GA", "GC", "TA"]
    assert len(words.words_with_a_code(2)) == 16 + 2 * 4 * 4 and len(set(words.words_with_a_code(3))) == 64 + 3 * 4 * 16
    seen = [a + b for a, b in words.pairs(1)]
    assert len(seen) == len({min(w, words.reverse(w)) for w in seen}) and {min(w, words.reverse(w)) for w in seen} == {min(a + b, words.reverse(a + b)) for a in "ACGTSWRY" for b in "ACGTSWRY"}
    assert words.gapped_repeats("CGG", 2) == ["CGGCGG", "CGGNCGG", "CGGCCG", "CGGNCCG", "CCGCGG", "CCGNCGG"]
    assert next(words.dimer_words(2)) == "AAAA" and "A.{0,1}T" in set(words.dimer_patterns(1)) and "ANA" in set(words.gapped_words(1, 2))


def test_distances():
    assert distances.euclidean(A, A) == 0 and distances.mean_distance(A, B) > 0
    assert distances.mean_distance(A, B) == pytest.approx(np.sqrt(((A.fractions - B.fractions) ** 2).sum(1) / 2).mean())
    n = Motif.from_text("TGANTCA")
    assert distances.informative(n).tolist() == [True] * 3 + [False] + [True] * 3
    assert distances.masked_distance(B, n) < distances.mean_distance(B, n) and distances.masked_distance(A, Motif.from_text("NNNNNNN")) == math.inf
    assert distances.weighted_distance(A, Motif.from_text("NNNNNNN")) == 1 and distances.directed_divergence(A, A) == 0
    assert distances.farthest(B) > distances.euclidean(A, B)
    i = np.arange(7)
    assert distances.range_scaled_bits(B, B, i, i) < distances.range_scaled_bits(A, B, i, i) and distances.range_product(B, B, i, i) < distances.range_product(A, B, i, i)
    assert distances.range_scaled_product(B, B, i, i) == -1 and distances.range_entropy(B, B, i, i) == 0 and distances.range_entropy(A, B, i, i) > 0
    assert distances.with_penalty(-5)(B, Motif.from_text("ACTGAGT"), i, i) >= distances.range_common_bits(B, B, i, i)
    assert distances.window_distance(B, B.part(1, 7)) == pytest.approx(0) and distances.overlap_distance(B, B.reverse()) == pytest.approx(0)
    d, shift, flipped = distances.overhang_distance(B, B.part(1, 7))
    assert d == pytest.approx(0) and shift == 1 and not flipped
    # TGACTC reversed is GAGTCA, which lies on its own motif the other way round
    assert distances.overhang_distance(Motif.from_text("GGTGACCC"), Motif.from_text("GGGTCA"))[2]
    assert distances.overlap_probability(B, B) < 1e-4 < 0.5 < distances.overlap_probability(B, Motif.from_text("AAAAAAA")) and distances.overlap_binomial(B, B) < 1e-4
    assert distances.overlap_score(B, B) > 4 and distances.word_frequency(Motif.from_text("ACG"), 3, 0.9) == pytest.approx(2 / 64)
    with pytest.raises(ValueError):
        distances.euclidean(A, A.part(0, 3))


def test_changed_motifs():
    bits = Motif.from_ratios(B.ratios)
    assert bits.fractions == pytest.approx(B.fractions) and bits.consensus == B.consensus
    assert B.with_pseudocounts(1).fractions == pytest.approx((B.fractions + 0.25) / 2)
    assert B.with_background({"A": 0.4, "C": 0.1, "G": 0.1, "T": 0.4}).ratios[2, 0] < B.ratios[2, 0]
    assert Motif.from_text("ANA").denoised(0.5).fractions[1] == pytest.approx([0.25] * 4)
    assert Motif.from_text("ACG").merged(Motif.from_text("GTT"), 2).consensus == "ACGTT" and Motif.from_text("A").merged(Motif.from_text("C"), 2).consensus == "A.C"
    rng = np.random.default_rng(0)
    assert sorted(B.shuffled_places(rng).fractions.sum(1)) == pytest.approx([1] * 7) and len(Motif.random(5, rng)) == 5
    assert B.shuffled_bases(rng).bits == pytest.approx(B.bits)
    codes = A.code_ratios
    assert codes["S"][3] == pytest.approx(A.ratios[3, [1, 2]].max()) and not codes["N"].any() and not codes["B"].any()


def test_scans():
    seq = "AATGACTCATTTGAGTCATGACTCATGACTCA"
    assert B.best_match(seq) == (pytest.approx(B.best), 2, "+", "TGACTCA") and B.best_match("AC") is None
    assert B.best_match("CCTGAGTCACC")[2:] == ("-", "TGACTCA")
    starts = B.starts(seq, 0.9 * B.best)
    assert starts == [2, 11, 18, 25] and B.separate_starts("TGACTCATGACTCA", 0.9 * B.best) == [0, 7]
    wide = Motif.from_text("ATAT")
    assert wide.starts("ATATATAT", wide.best - 0.01) == [0, 2, 4]
    assert wide.separate_starts("ATATATAT", wide.best - 0.01) == [0, 4]
    assert B.masked("CCTGACTCACC", 0.9 * B.best) == "CCNNNNNNNCC"
    assert B.neighbourhoods("A" * 20 + "TGACTCA" + "A" * 20, 0.9 * B.best, 3) == ["AAATGACTCAAAA"] and B.neighbourhoods(seq, 0.9 * B.best, 5) == [seq]
    assert B.scores_above("TGACTCATGACTCA", 0.9 * B.best) == pytest.approx(2 * B.best) and B.total("AC") == -math.inf and B.total(seq) > B.best
    assert B.scan_short("GACT") == [(1, pytest.approx(B.part(1, 5).best), "+")] and B.score("TGACTCA") == pytest.approx(B.best)
    assert B.threshold(["CCTGACTCA", "TGACTCATT"], 2) == pytest.approx(B.best)


def test_statistics():
    assert stats.log2_sum([1, 1]) == 2 and stats.log2_sum([-math.inf]) == -math.inf and stats.neg_log10_of(0) == pytest.approx(299)
    mean, error = stats.best_poisson([0, 1, 1, 2, 2, 2, 3, 3, 4, 1, 2])
    assert 1.3 < mean < 2.1 and error < 0.1
    w, p = stats.shapiro_wilk([1, 2, 4])
    assert w == pytest.approx(0.9643, abs=1e-4) and p == pytest.approx(0.637, abs=1e-3)
    with pytest.raises(ValueError):
        stats.shapiro_wilk([1, 2])
    assert stats.ks_tail(0, 10, 10) == 1 and stats.ks_tail(1, 50, 50) < 1e-6


def test_candidates():
    c = candidates.Candidate()
    c.words.update({"TGACTCA": 5, "TGAGTCA": 3})
    before = c.score()
    assert c.grow([("TGACTCA", 2), ("CCCCCCC", 1), ("TGACTCC", 4)]) == ["TGACTCC"] and c.score() > before and c.words["TGACTCC"] == 4
    c.words["GGGGGGG"] = 1
    assert c.purge() == ["GGGGGGG"] and set(c.words) == {"TGACTCA", "TGAGTCA", "TGACTCC"}
    assert c.score({w: -n for w, n in c.words.items()}) == -math.inf
    again = candidates.best_words(c, ["AAATGACTCAAA", "CCTGAGTCACC", "GG"])
    assert sum(again.words.values()) == 2


def test_medoid_runs_and_rules(spark):
    x = np.array([0, 1, 2, 50, 51, 52, 100, 101, 102], dtype=float)
    pairs = spark.createDataFrame([(f"p{i}", f"p{j}", abs(float(x[i] - x[j]))) for i in range(9) for j in range(i)], "i string, j string, d double")
    runs = cluster.k_medoids_runs(pairs, list(range(1, 7)), list(range(12))).cache()
    for rule, bound in (("tight", 2), ("apart", 10), ("drop", 0)):
        r = cluster.best_run(runs, rule, bound).first()
        assert r.medoids == ["p1", "p4", "p7"] or rule == "drop" and r.k in (2, 3)
    three = cluster.best_run(runs.where("k = 3"), "total").first()
    assert (three.total, three.widest, three.nearest, three.medoids) == (6.0, 1.0, 50.0, ["p1", "p4", "p7"])
    assert cluster.best_run(runs, "widest").first().k == 6 and runs.where("k = 1 AND nearest IS NULL").count() == 12
    assert cluster.k_medoids_runs(pairs.where("d < 0"), [2], [1]).collect() == []
    with pytest.raises(ValueError):
        cluster.k_medoids_runs(pairs, [2], [1], most=5)
    with pytest.raises(ValueError):
        cluster.best_run(runs, "any")


def test_site_metrics():
    h = pd.DataFrame({"own": [True, True, True, False, False], "n": [0, 1, 3, 0, 1], "probes": [2, 3, 1, 30, 4], "bases": [200, 300, 100, 3000, 400]})
    assert search.by_probe(h) == pytest.approx(stats.hypergeometric_tail(4, 6, 8, 40)) and search.share_with_site(h) == pytest.approx(4 / 6)
    assert search.by_site(h, 5) == pytest.approx(stats.hypergeometric_tail(6, 6, 10, 40)) and search.by_repeated_site(h) == pytest.approx(stats.hypergeometric_tail(5, 12, 9, 80))
    assert search.by_base(h) == pytest.approx(stats.hypergeometric_tail(6, 600, 10, 4000)) and search.over_represented(h) == pytest.approx(stats.binomial_tail(6, 10, 0.15))
    auc = (2 * 15 + 3 * (30 + 2) + 34) / (6 * 34)
    assert search.roc_auc(h) == pytest.approx(auc) and 0 <= search.chi2(h) <= 1
    assert search.mncp(h) == pytest.approx((2 * 1 + 3 * (4 / 6) / (8 / 40) + (1 / 6) / (1 / 40)) / 6)
    empty = h.assign(n=0)
    assert search.by_probe(empty) == 1 and search.roc_auc(empty) == 0.5 and search.mncp(empty) == 1


ALIGNACE = """AlignACE 3.0
Motif 1
TGACTCA\t0\t5\t1
TGAGTCA\t1\t9\t0
*******
MAP Score: 12.5
Motif 2
AAAA\t0\t1\t1
****
MAP Score: 5000
"""
MDSCAN = "header\nMtf 1\nFinal Motif 1: Wid 7; Score 3.25; Sites 2\n>a Len 1 Site 1 f TGACTCA\n>b Len 1 Site 1 f TGAGTCA\n"
MEME = """Background letter frequencies (from dataset):
A 0.300 C 0.200 G 0.200 T 0.300
MOTIF  1   width =    3   sites =   2   llr = 9   E-value = 1.2e-004
Motif 1 in BLOCKS format
-----
BL   MOTIF 1 width=3 seqs=2
s1  (  5) ACX  1
s2  (  7) ACG  1
//
Motif 1 position-specific probability matrix
-----
letter-probability matrix: alength= 4 w= 3
 0.9 0.1 0.0 0.0
 0.0 1.0 0.0 0.0
 0.0 0.0 1.0 0.0
-----
"""


def test_program_outputs():
    a, b = programs.parse_alignace(ALIGNACE)
    assert a.motif.consensus.upper() == "TGASTCA" and a.metrics == {"MAP": 12.5} and a.seqs == ["TGACTCA", "TGAGTCA"] and b.metrics["MAP"] == 0
    (m,) = programs.parse_mdscan(MDSCAN)
    assert m.motif.consensus.upper() == "TGASTCA" and len(m.seqs) == 2
    (e,) = programs.parse_meme(MEME)
    assert e.motif.consensus.upper() == "ACG" and e.metrics["evalue"] == 1.2e-4 and e.seqs == ["ACN", "ACG"] and e.motif.background[0] == 0.3
    assert [f.metrics["MAP"] for f in programs.convert(ALIGNACE, "alignace", least={"church": 1.0})] == [12.5, 0] and programs.parse_meme("") == []
    read = lambda name: [A, B]
    assert [n for n, _ in programs.motifs_of("TGASTCA,ACGT", read)] == ["TGASTCA", "ACGT"] and programs.motifs_of("x.txt:1", read)[0][1] is B and len(programs.motifs_of("x.txt", read)) == 2
    text = sinks.motif_text(B, 1, {"p": 0.01}, words=3)
    assert "p: 0.01" in text and text.count("TGACTCA") >= 3


def test_configuration():
    got = config.runs([{"file1": "a", "name": "x", "threads": 2}, None, {"defaults": {"threads": 8, "nofr4cut": None}}, {"file1": "b"}])
    assert got == [{"threads": 2, "nofr4cut": None, "file1": "a", "name": "x"}, {"threads": 8, "nofr4cut": None, "file1": "b"}]
    assert config.arguments(got[1]) == ["--threads", "8", "--nofr4cut", "--file1", "b"]
    for bad in ([{"yaml": "z"}], [{"defaults": {}, "more": 1}]):
        with pytest.raises(ValueError):
            config.runs(bad)
    assert config.requires("math")(lambda: 1)() == 1 and config.requires("no_such_package", otherwise=lambda: 2)(lambda: 1)() == 2
    with pytest.raises(ImportError):
        config.requires("no_such_package")(lambda: 1)()
    assert config.disabled_on("linux", "darwin", "win")(lambda: 1)() is None


assert UNIFORM["A"] == 0.25

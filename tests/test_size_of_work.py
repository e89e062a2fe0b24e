"""What large tables ask of the library: small intermediate tables, one reading of the texts, results as before."""

from __future__ import annotations

import glob
import os

import numpy as np
import pytest

from paratope.operators import em, motif_table


def _texts(rng, n, size):
    return ["".join(rng.choice(list("ACGT"), size)) for _ in range(n)]


def test_letters_of_a_search_take_less_than_a_byte_each(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(s,) for s in _texts(rng, 100, 2000)], "seq string")
    table = em.packed(df, em.Background.even())
    files = glob.glob(table._written.removeprefix("file://") + "/*.parquet")
    assert sum(r.n for r in table.selectExpr("length(text) AS n").collect()) == 100 * 2001
    assert 0 < sum(map(os.path.getsize, files)) < 100 * 2000


@pytest.mark.parametrize("order", [0, 1, 2])
def test_odds_are_those_of_windows(spark, order):
    rng = np.random.default_rng(order)
    seqs = [*_texts(rng, 5, 60), "ACGTNACGTACGTNNACGTAACC", "ACG"]
    background = em.Background.of(spark.createDataFrame([(s,) for s in seqs], "seq string"), order)
    codes = [em._CODE[np.frombuffer(s.encode(), np.uint8)] for s in seqs]
    text = np.concatenate([x for c in codes for x in (c.astype(np.uint8), em._MARK)])
    for width in (3, 7, 9, 33):
        words, word, odds, first, sizes = em._windows(text, np.array([len(s) for s in seqs]), width, background)
        plain = [(s, c, i) for s, c in zip(seqs, codes, strict=True) for i in range(len(c) - width + 1) if (c[i : i + width] < 4).all()]
        assert ["".join("ACGT"[x] for x in words[w]) for w in word] == [s[i : i + width] for s, _, i in plain]
        want = np.concatenate([(2.0 ** -background.windows(c, width))[[i for _, d, i in plain if d is c]] for c in codes if len(c) >= width])
        assert odds == pytest.approx(want, rel=1e-9)
        assert sizes.tolist() == [len(s) for s in seqs if any(x is s for x, *_ in plain)]


def test_a_rare_word_is_tried_too(spark):
    """Before, only the thousand words most frequent in the subset were tried, and this one comes after 1,500 others."""
    rng = np.random.default_rng(4)
    common = _texts(rng, 1, 4000)[0].replace("GATTAC", "GAATAC").replace("GTAATC", "GTATTC") * 2
    rows = [(i, common + ("CCGATTACCC" if i < 6 else "CC")) for i in range(14)]
    probes = spark.createDataFrame(rows, "probe_id long, seq string")
    assert "GATTAC" in em.enriched_words(probes, probes.where("probe_id < 6"), 6, kept=5)


@pytest.mark.parametrize("width", [5, 13])
def test_word_probes_are_those_of_all_metrics(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, s) for i, s in enumerate([*_texts(rng, 12, 50), "ACGTNACGTACGTACGTNNacgtaacc", "AC", "", None])]
    rows += [(90, rows[0][1]), (91, rows[0][1][:30])]
    probes = spark.createDataFrame(rows, "probe_id long, seq string").repartition(3)
    subset = probes.where("probe_id % 3 = 0").select("probe_id")
    words = {w: [w] for _, s in rows if s for i in range(len(s) - width + 1) if set(w := s[i : i + width].upper()) <= set("ACGT")}
    words = {min(w, w.translate(motif_table.FLIP)[::-1]): v for w, v in words.items()}
    want = {r.motif: r for r in motif_table.evaluate_all(probes, subset, words).collect() if r.found}
    got = {r.motif: r for r in motif_table.word_probes(probes, subset, width).collect()}
    assert got.keys() == want.keys() and got
    assert all((got[w].found, got[w].marked, got[w].draws, got[w].total) == (want[w].found, want[w].marked, want[w].draws, want[w].total) for w in got)
    assert all(got[w].probe == pytest.approx(want[w].probe) for w in got)


def test_a_round_reads_each_word_of_a_sequence_once(spark):
    """Before, each round numbered every window of the letters again."""
    seqs = ["ACGTTGCA" * 50, "GATTACA" * 30, "ACGNNACGTAC", "AC"]
    df = spark.createDataFrame([(s,) for s in seqs], "seq string")
    background = em.Background.of(df, 2)
    rows = em.summed(df, background, 5).collect()
    least = {min(w, w.translate(motif_table.FLIP)[::-1]) for s in seqs[:1] for i in range(len(s) - 4) if set(w := s[i : i + 5]) <= set("ACGT")}
    counts = {n: many for r in rows for n, many in zip(np.frombuffer(r["size"], np.int64).tolist(), np.frombuffer(r.many, np.int32).tolist(), strict=True)}
    assert counts[400] == len(least) and sum(counts.values()) == sum(r.words for r in rows) and 2 not in counts

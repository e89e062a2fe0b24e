"""Expectation maximisation against a plain loop written from the model's definition."""

import math

import numpy as np
import pytest

from paratope import catalog
from paratope.operators import em
from paratope.operators.motifs import Motif

FLIP = str.maketrans("ACGT", "TGCA")


def conditional(seqs, order):
    """{context + letter: probability} for contexts of up to ``order`` letters, both strands, one count added."""
    counts = {}
    for s in seqs:
        for t in (s.upper(), s.upper().translate(FLIP)[::-1]):
            for k in range(order + 1):
                for i in range(len(t) - k):
                    w = t[i : i + k + 1]
                    if set(w) <= set("ACGT"):
                        counts[w] = counts.get(w, 0) + 1
    p = lambda w: (counts.get(w, 0) + 1) / (sum(counts.get(w[:-1] + b, 0) for b in "ACGT") + 4)
    return p


def log_background(p, s, order):
    total = 0.0
    for i in range(len(s)):
        for k in range(min(order, i), -1, -1):
            w = s[i - k : i + 1]
            if set(w) <= set("ACGT"):
                total += math.log2(p(w))
                break
        else:
            total -= 2
    return total


def plain(seqs, motif, p, order, gamma=0.2, beta=0.001, stop=1e-3, rounds=499):
    width, prior = len(motif), gamma
    m = np.log2(motif.fractions)
    base = [p(b) for b in "ACGT"]
    for n in range(1, rounds + 1):
        counts, held, gain, used = np.zeros((width, 4)), 0.0, 0.0, 0
        for s in seqs:
            s = s.upper()
            terms = []
            for i in range(len(s) - width + 1):
                w = s[i : i + width]
                if not set(w) <= set("ACGT"):
                    continue
                left, right = s[max(0, i - order) : i], s[i + width : i + width + order]
                bg = log_background(p, left + w + right, order) - log_background(p, left, order) - log_background(p, right, order)
                for word in (w, w.translate(FLIP)[::-1]):
                    terms.append((word, 2 ** (sum(m[j]["ACGT".index(c)] for j, c in enumerate(word)) - bg) * gamma / len(s)))
            if not terms:
                continue
            used += 1
            whole = 1 - gamma + sum(x for _, x in terms)
            gain += math.log2(whole)
            for word, x in terms:
                held += x / whole
                for j, c in enumerate(word):
                    counts[j]["ACGT".index(c)] += x / whole
        column = counts.sum(1, keepdims=True)
        new = np.log2((counts + beta * np.array(base) * column) / (column + beta))
        moved = math.sqrt(((2**m - 2**new) ** 2).sum())
        m, gamma = new, 0.8 * prior + 0.2 * held / used
        if moved <= stop:
            break
    return counts, gamma, gain, n


@pytest.fixture(scope="module")
def seqs():
    rng = np.random.default_rng(3)
    out = ["".join(rng.choice(list("ACGT"), int(rng.integers(20, 45)))) for _ in range(12)]
    return [s[:9] + ("TGACTCA" if i % 3 else "TGAGTCA") + s[9:] for i, s in enumerate(out)] + ["acgtnACGTTTTGCANNA", "ACG"]


@pytest.mark.parametrize("order", [0, 2])
def test_equal_to_a_plain_loop(spark, seqs, order, monkeypatch):
    monkeypatch.setattr(em, "ROW", 60)
    df = spark.createDataFrame([(s, 1) for s in [*seqs, None, ""]], "seq string, width int").repartition(3)
    background = em.Background.of(df, order)
    p = conditional(seqs, order)
    for k, t in enumerate(background.tables):
        for n, x in enumerate(t):
            w = "".join("ACGT"[n // 4**j % 4] for j in reversed(range(k + 1)))
            assert math.isclose(2**x, p(w), rel_tol=1e-6)
    seeds = em.seed_matrices(["TGACTCA", "ACGTA"], background)
    got = em.em(df, seeds, background)
    for t, m in seeds.items():
        counts, gamma, gain, n = plain(seqs, m, p, order)
        found, share, own_gain, rounds = got[t]
        want = Motif.from_counts(counts, background.bases, 0.001)
        assert abs(rounds - n) <= 1
        assert np.allclose(found.fractions, want.fractions, atol=2e-3)
        assert math.isclose(share, gamma, rel_tol=1e-3) and math.isclose(own_gain, gain, rel_tol=1e-3, abs_tol=1e-2)
    assert got["TGACTCA"][0].consensus in ("TGASTCA", "TGACTCA")


def test_rounds_and_sequences_without_windows(spark, seqs):
    df = spark.createDataFrame([(s,) for s in seqs], "seq string")
    background = em.Background.even()
    one = em.em(df, em.seed_matrices(["TGACTCA"], background), background, rounds=1)
    assert one["TGACTCA"][3] == 1
    none = spark.createDataFrame([("NNNN",), (None,), ("AC",)], "seq string")
    seed = em.seed_matrices(["TGACTCA"], background)
    found, share, gain, n = em.em(none, seed, background)["TGACTCA"]
    assert found is seed["TGACTCA"] and n == 0 and gain == 0
    assert em.em(df, {}, background) == {}


def test_discover_finds_a_planted_word(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(90):
        s = "".join(rng.choice(list("ACGT"), 60))
        rows.append((i, s[:20] + "CACGTGA" + s[20:] if i < 30 else s))
    probes = spark.createDataFrame(rows, "probe_id long, seq string").repartition(2)
    scores = spark.createDataFrame([(i, -float(i)) for i in range(90)], "probe_id long, score double")
    got = em.discover(probes, probes.where("probe_id < 30").select("probe_id"), 7, seeds=["TTTTTTT"], top=8, scores=scores, enriched=2, order=1).collect()
    best = min(got, key=lambda r: r.p)
    assert best.consensus.upper() in ("CACGTGA", "TCACGTG") and best.p < 1e-10 and best.found == 1.0 and best.specificity == 1.0
    assert "TTTTTTT" in {r.seed for r in got} and len(got) >= 4


def test_the_query_ends(spark):
    got = {r.seed: r for r in catalog.QUERIES["m30_em"](spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == {"TGACTCA", "ACGTAC"} and all(r.gain > 0 and 0 < r.share < 1 for r in got.values())

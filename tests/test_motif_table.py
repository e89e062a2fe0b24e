"""Metrics of many motifs at once against a count in plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from paratope.functions import words
from paratope.functions.sequences import IUPAC
from paratope.functions.stats import binomial_tail, binomial_tails, hypergeometric_tail, hypergeometric_tails
from paratope.operators import motif_table, search
from paratope.operators.motifs import Motif

FLIP = str.maketrans("ACGTRYKMSWN", "TGCAYRMKSWN")


def places(text, seq):
    out = set()
    for t in (text, text.translate(FLIP)[::-1]):
        r = "".join("." if c == "N" else f"[{IUPAC[c]}]" for c in t)
        out |= {m.start() for m in re.finditer(f"(?=({r}))", seq.upper())}
    return sorted(out)


def apart(at, width):
    out = []
    for p in at:
        if not out or p >= out[-1] + width:
            out.append(p)
    return out


@pytest.fixture(scope="module")
def seqs():
    rng = random.Random(1)
    out = [(i, "".join(rng.choice("ACGT" if i % 5 else "AAAAACGTNacgt") for _ in range(rng.randint(0, 300)))) for i in range(120)]
    return [*out, (500, None), (501, ""), (502, "ACGTACG"), (503, "A" * 50), (504, "ACACACACACACACAC")]


@pytest.fixture(scope="module")
def tables(spark, seqs):
    probes = spark.createDataFrame([(i, s, "x", True) for i, s in seqs], "probe_id long, seq string, motif string, own boolean").repartition(3)
    return probes, spark.createDataFrame([(i,) for i, _ in seqs if i % 3 == 0] + [(0,), (9999,)], "probe_id long")


def histogram(seqs, text):
    c = Counter()
    for i, s in seqs:
        at = places(text, s or "")
        if at:
            c[i % 3 == 0, len(apart(at, len(text))), len(at)] += 1
    return c


def test_histograms(tables, seqs, monkeypatch):
    listed = ["ACGT", "AAAA", "ACAC", "GTR", "ANNC", "RNNNNY", "CANNNNNNNNNNNNTG", "A"]
    monkeypatch.setattr(motif_table, "RUN", 500)
    monkeypatch.setattr(motif_table, "MOST_WORDS", 6)  # several passes
    got = motif_table.site_histograms(*tables, motif_table.texts(listed)).collect()
    for t in listed:
        assert {(r.own, r.sites, r.starts): r.probes for r in got if r.motif == t} == histogram(seqs, t), t


def test_metrics_equal_those_of_one_motif(tables, seqs):
    import pandas as pd

    listed = ["ACG", "AAAA", "GTRA", "ANNC"]
    got = {r.motif: r for r in motif_table.evaluate_all(*tables, motif_table.texts(listed)).collect()}
    for t in listed:
        rows = [(i % 3 == 0, len(apart(places(t, s or ""), len(t))), len(s or "")) for i, s in seqs]
        h = pd.DataFrame(rows, columns=["own", "n", "bases"]).groupby(["own", "n"], as_index=False).agg(probes=("bases", "size"), bases=("bases", "sum"))
        r = got[t]
        want = {"probe": search.by_probe(h), "repeated": search.by_repeated_site(h), "base": search.by_base(h), "over_represented": search.over_represented(h), "share": search.share_with_site(h), "chi2": search.chi2(h), "mncp": search.mncp(h), "roc_auc": search.roc_auc(h)}
        for name, x in want.items():
            assert math.isclose(r[name], x, rel_tol=1e-7, abs_tol=1e-12), (t, name, r[name], x)
        two = [len(places(t, s or "")) >= 2 for _, s in seqs]
        f2 = sum(x for x, (i, _) in zip(two, seqs) if i % 3 == 0)
        assert math.isclose(r.site, hypergeometric_tail(f2, r.draws, sum(two), r.total) if f2 else 1.0, rel_tol=1e-9)


def test_tails_of_arrays():
    rng = random.Random(3)
    rows = [(rng.randint(-1, 30), rng.randint(0, 40), rng.randint(0, 60), 60) for _ in range(500)] + [(900, 1000, 5000, 100000), (0, 10, 5, 60), (70, 1000, 5000, 100000)]
    rows = [r for r in rows if r[0] <= min(r[1], r[2])]
    for got, r in zip(hypergeometric_tails(*zip(*rows)), rows):
        assert math.isclose(got, hypergeometric_tail(*r), rel_tol=1e-9, abs_tol=1e-13), r
    rows = [(rng.randint(0, 40), 40, rng.choice([0.0, 0.01, 0.3, 0.99, 1.0])) for _ in range(300)]
    for got, r in zip(binomial_tails(*zip(*rows)), rows):
        assert math.isclose(got, binomial_tail(*r), rel_tol=1e-9, abs_tol=1e-12), r


def test_best_thresholds_equal_a_search_of_each(tables, seqs):
    named = {"x": Motif.from_text("ACGT"), "y": Motif.from_text("GTRAC")}
    factors = (0.5, 0.7, 0.9)
    got = {r.motif: (r.factor, r.p) for r in motif_table.best_thresholds(*tables, named, factors).collect()}
    for name, m in named.items():
        best = None
        for f in reversed(factors):
            hit = [bool(s) and any(max(a, b) >= f * m.best - 1e-9 for a, b in zip(*m.scores("".join(c if c in "ACGT" else "N" for c in s.upper())))) for _, s in seqs]
            # a window with another letter is no site here
            hit = [bool(s) and any(m.score(s.upper()[j : j + len(m)]) >= f * m.best - 1e-9 or m.reverse().score(s.upper()[j : j + len(m)]) >= f * m.best - 1e-9 for j in range(len(s) - len(m) + 1) if set(s.upper()[j : j + len(m)]) <= set("ACGT")) for _, s in seqs]
            found = sum(h for h, (i, _) in zip(hit, seqs) if i % 3 == 0)
            p = hypergeometric_tail(found, sum(i % 3 == 0 for i, _ in seqs), sum(hit), len(seqs)) if found else 1.0
            if best is None or p < best[1] - 1e-12:
                best = (f, p)
        assert got[name][0] == best[0] and math.isclose(got[name][1], best[1], rel_tol=1e-9)


def test_omitted_empty_and_refused(spark, tables, seqs):
    none = spark.createDataFrame([], "probe_id long, seq string")
    assert motif_table.evaluate_all(none, none, motif_table.texts(["ACG"])).collect() == []
    assert motif_table.evaluate_all(*tables, {}).collect() == []
    assert {m: search.METRICS[m](search.histogram(search.site_counts(none, none, Motif.from_text("ACG")))) for m in search.METRICS}["chi2"] == 1.0
    left = motif_table.totals(*tables, omit=tables[1]).first()
    assert left.draws == 0 and left.total == sum(i % 3 != 0 for i, _ in seqs)
    for bad in ("NNN", "AZ", "", "N" * 3 + "RRRRRRRRRRRRRRRRRR"):
        with pytest.raises(ValueError):
            motif_table.text_words(bad)


def test_sources_of_motifs(spark):
    assert len(motif_table.all_words(5)) == 4**5 // 2 and len(motif_table.all_words(2)) == 10
    assert len(motif_table.texts(words.dimer_words(2, 3))) == len(set(words.dimer_words(2, 3)))
    seqs = spark.createDataFrame([("ACGACGACG",), ("TTTTNTT",)], "seq string")
    assert list(motif_table.frequent_words(seqs, [3], 2)) == ["ACG", "AAA"] or set(motif_table.frequent_words(seqs, [3], 2)) <= {"ACG", "CGA", "AAA", "GAC"}

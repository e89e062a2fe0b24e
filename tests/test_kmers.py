"""Canonical k-mers of several widths in one pass against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paratope.operators import motif_table, motifs


def test_top_words_of_several_widths(spark, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ACGTacgtN") for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, "", "ACG", "ACXGTACXGT" * 3, "ACXGTACXGT", "éACGT-TACG", "A" * 40]
    frame = spark.createDataFrame([(t,) for t in texts], "seq string").repartition(3)
    letters = str.maketrans("ACGT", "TGCA")
    for k in (1, 3, 4):
        want = Counter()
        for t in texts:
            t = (t or "").upper()
            for i in range(len(t) - k + 1):
                w = t[i : i + k]
                if "N" not in w:
                    want[min(w, w.translate(letters)[::-1])] += 1
        assert {r.kmer: r.cnt for r in motifs.top_kmers(frame, k).collect()} == want
        top = sorted(want.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert [tuple(r) for r in motifs.top_kmers_of(frame, [3, k, 12], 20)[k].collect()] == top
    passes = []
    old = motifs.canonical_counts
    monkeypatch.setattr(motifs, "canonical_counts", lambda *a: (passes.append(a[1]), old(*a))[1])
    found = motif_table.frequent_words(frame, range(3, 6), 5)
    assert passes == [[3, 4, 5]] and found and all(set(w) <= set("ACGT") for w in found)
    # What leaves a task is bounded by its table, however long its texts are.
    many = spark.createDataFrame([("ACGTTGCA" * 50,)] * 2000, "seq string").coalesce(1)
    assert old(many, [2]).agg(F.count("*")).first()[0] <= 10
    with pytest.raises(ValueError):
        old(frame, [12])

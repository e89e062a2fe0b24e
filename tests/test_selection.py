"""FASTQ files in several splits, selection per experiment, upstream motif sets, genes of indelled primers."""

import gzip
import random
from collections import Counter

import pytest

from paratope.operators import hts, primer, upstream
from paratope.sources import sequences as files


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_in_many_splits(spark, tmp_path, end):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        n = rng.randint(1, 60)
        rows.append((f"r{i}", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@@@+IH") for _ in range(n))))
    text = "".join(f"@{i} lane 7{end}{s}{end}+{i if k % 3 else ''}{end}{q}{end}" for k, (i, s, q) in enumerate(rows))
    (tmp_path / "a.fastq").write_bytes(text.encode())
    with gzip.open(tmp_path / "b.fastq.gz", "wb") as f:
        f.write(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        plain, packed = (files.read_fastq(spark, str(tmp_path / n), "s") for n in ("a.fastq", "b.fastq.gz"))
        assert plain.rdd.getNumPartitions() > 20
        for df in (plain, packed):
            assert sorted((r.read_id, r.seq, r.qual) for r in df.collect()) == sorted(rows)
        assert plain.first().header.endswith("lane 7")
        both = files.read_fastq(spark, str(tmp_path), "s")
        assert both.count() == 6000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_selected(spark):
    rng = random.Random(2)
    rows = [(e, f"p{i:02}", rng.choice([None, 1.0, round(rng.random() * 9, 1)])) for e in "abc" for i in range(30)]
    bad = {"a": 3, "b": 2, "c": 0}
    df = spark.createDataFrame(rows, "experiment string, probe string, value double").repartition(3)
    for kind, keep in (({"top": 7}, None), ({"most": 2.0}, lambda v: v <= 2.0), ({"ratio": 5.0}, lambda v: v >= 5.0)):
        want = {}
        for e in bad:
            own = sorted((v, p) for x, p, v in rows if x == e and v is not None)
            want[e] = own[:7] if keep is None else [t for t in own if keep(t[0])]
        listed = {p for e, n in bad.items() for _, p in want[e][:n]}
        got = {}
        for r in sorted(hts.selected(df, spark.createDataFrame([(p,) for p in listed] * 2, "probe string"), **kind).collect(), key=lambda r: r.place):
            got.setdefault(r.experiment, []).append((r.value, r.probe))
            assert r.place == len(got[r.experiment])
        for e, own in want.items():
            left = [t for t in own if t[1] not in listed]
            assert got.get(e, []) == (left if len(own) - len(left) > 2 else own)
    assert hts.selected(df.where("value > 99"), None, top=3).collect() == []


def test_motif_sets(spark):
    rows = [("a", "IGHV1-2*01", "ATGAAA"), ("b", "IGHV1-2*02", "ATGCAA"), ("c", "IGHV1-3*01", "CTGAAA"), ("d", "IGHV1-3*01", "ATGTAA"), ("e", "IGHV1-3*01", "ATG")]
    got = {(r.level, r.name, r.kind, r.pos, r.letter): r.cnt for r in upstream.motif_counts(upstream.classify(spark.createDataFrame(rows, "id string, vgene string, upstream string"), "secsig", (6, 6))).collect()}
    assert got["family", "IGHV1", "dna", 0, "A"] == 2 and got["gene", "IGHV1-2", "dna", 3, "C"] == 1 and got["variant", "IGHV1-2*02", "protein", 1, "Q"] == 1
    assert got["gene", "IGHV1-3", "untranslated", 0, "C"] == 1 and got["gene", "IGHV1-3", "faulty", 3, "T"] == 1
    assert sum(n for (level, _, kind, _, _), n in got.items() if level == "family" and kind == "dna") == 12
    assert not [k for k in got if k[0] == "gene" and k[1] == "IGHV1-3" and k[2] == "dna"]


def test_genes_of_indelled_primers(spark):
    rows = [("P1", 3, "IGHV1-2*01"), ("P1", 3, "IGHV1-2D*02"), ("P1", 0, "IGHV9-9*01"), ("nan", 2, "IGHV1-2*01"), ("P2", 1, "IGHV3-1*01"), ("P2", 1, None)]
    got = Counter({(r.primer, r.level, r.name): r.cnt for r in primer.indelled_genes(spark.createDataFrame(rows, "primer5 string, indel5 int, vgene string"), "5").collect()})
    assert got == {("P1", "gene", "IGHV1-2"): 1, ("P1", "gene", "IGHV1-2D"): 1, ("P1", "family", "IGHV1"): 2, ("P1", "all", "all"): 2, ("P2", "gene", "IGHV3-1"): 1, ("P2", "family", "IGHV3"): 1, ("P2", "all", "all"): 1}


def test_aligned_groups(spark):
    from paratope.functions.align import centre_star
    from paratope.operators import motifs

    rng = random.Random(4)
    rows = []
    for g in ("g1", "g2", None):
        base = "".join(rng.choice("ACGT") for _ in range(16))
        for _ in range(9):
            s = list(base)
            del s[rng.randrange(len(s))]
            s.insert(rng.randrange(len(s)), rng.choice("ACGT"))
            rows.append((g, "".join(s)))
    rows += [("one", "ACGT"), ("one", "ACGT"), ("one", ""), ("one", None)]
    df = spark.createDataFrame(rows, "gene string, seq string").repartition(3)
    got = {}
    for r in motifs.aligned(df, "gene", most=50).collect():
        got.setdefault(r.gene, {})[r.seq] = r.aligned
    for g in {g for g, _ in rows}:
        own = sorted({s for h, s in rows if h == g and s})
        assert [got[g][s] for s in own] == centre_star(own)
        assert len({len(a) for a in got[g].values()}) == 1 and all(a.replace("-", "") == s for s, a in got[g].items())
    few = motifs.stable_sample(df, "gene", most=4)
    assert {(r.gene, r["count"]) for r in few.groupBy("gene").count().collect()} == {("g1", 4), ("g2", 4), (None, 4), ("one", 1)}
    assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, motifs.stable_sample(df.repartition(1), "gene", most=4).collect()), key=str)
    assert motifs.aligned(df.where("seq = 'x'"), "gene").collect() == []

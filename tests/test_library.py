"""Micro-fixtures of the repertoire operators, and the registered queries against DuckDB on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from paratope import catalog
from paratope.functions import align, stats, words
from paratope.functions import sequences as S
from paratope.operators import cluster, diversity, filters, hts, motifs, refine, restriction, search, upstream
from paratope.plans import session, sinks
from paratope.sources import reports, tables
from paratope.sources import sequences as files
from paratope.streaming import ingest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    text = lambda x: "%.9g" % x if isinstance(x, float) else "None" if x is None or x != x else str(x)
    return sorted(tuple(text(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, map(tuple, got.collect())) == rows(names, want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 7
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_iupac(tmp_path, spark):
    path = tmp_path / "sites.txt"
    path.write_text("# enzymes\nENZ1 AAAAA\nENZ2\tAAAAB\nENZ3 RYS\nENZ4 NNN\nENZ5 XFI\n")
    assert reports.site_regexes(reports.read_sites(spark, str(path))) == {"ENZ1": "AAAAA", "ENZ2": "AAAA[CGT]", "ENZ3": "[AG][CT][CG]", "ENZ4": "...", "ENZ5": "XFI"}
    assert S.iupac_regex("nnvh1") == "..[ACG][ACT]1"
    one = spark.createDataFrame([("ACGTACGT",)], "seq string")
    at = lambda r: one.select(restriction.hit_positions(F.col("seq"), r).alias("p")).first().p
    assert at("[ACG][ACG][GT]T") == [0, 4] and at("[ACG][ACG][GT]TAC[GT][TA]") == [0]


def test_sequence_columns(spark):
    d = spark.createDataFrame([("ATGTAAGGNA", "IGHV1-2D*01"), ("", None), (None, "IGHV3/OR15-1*02")], "s string, g string")
    got = d.select(S.translate_dna(F.col("s")).alias("p"), S.reverse_complement(F.col("s")).alias("r"), S.family(F.col("g")).alias("f"), S.family(F.col("g"), False).alias("n")).collect()
    assert [tuple(r) for r in got] == [("M*X", "TNCCTTACAT", "IGHV1", "IGHV1"), ("", "", None, None), (None, None, "IGHV3", "IGHV3")]
    assert d.select(S.slice_read(F.lit("ABCDEFGH"), F.lit(5), F.lit(2), F.lit(7)).alias("x")).first().x == "DEFG"


def test_filters_reject_missing(spark):
    d = spark.createDataFrame([("a", "v", 300.0, 250, 3, 1), ("b", "v", None, 300, 1, 1), ("c", "v", 299.0, 300, 1, 1)], "queryid string, vgene string, bitscore double, alignlen int, vstart int, vqstart int")
    assert [r.queryid for r in filters.accepted(d).collect()] == ["a"] and filters.rejected(d).count() == 2


def test_alignment():
    assert align.best_alignment("TTTTWGQGTLVTVSSAAA", "WGQGTXVTVSS", False) == (5, 15, False)
    assert align.best_alignment("", "ACG", True) is None
    score, path = align.local("ACGTACGT", "GTAC", "dna", -2)
    assert score == 4 and [i for i, _ in path] == [2, 3, 4, 5]
    assert align.match_pattern("TTGGTACGTTACGATT", [("P", "GGTACGTTACGA"), ("Q", "CCCC")], True) == ("P", 0, 0, 3, 14)
    name, mismatch, indel, *_ = align.match_pattern("GGTACCTTACGA", [("P", "GGTACGTTACGA")], True)
    assert (name, mismatch, indel) == ("P", 6, 0)
    assert align.match_pattern("GGTACé", [("P", "GGTACG")], True)[0] == "P"
    assert align.best_identity("ACGT", "TTACGTTT") == 4 and align.best_identity("GGGG", "TTCCCCTT") == 4
    assert align.centre_star(["ACGT", "ACT", "ACGT"])[1].replace("-", "") == "ACT"


def test_statistics():
    assert stats.hypergeometric_tail(2, 3, 4, 10) == pytest.approx((6 * 6 + 4) / 120)
    assert stats.binomial_tail(2, 3, 0.5) == pytest.approx(0.5) and stats.poisson_tail(1, 2.0) == pytest.approx(1 - math.exp(-2))
    assert stats.normal_tail(1.959964) == pytest.approx(0.025, abs=1e-6) and stats.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert stats.exact_rank_sum_tail(9, 2, 3) == pytest.approx(1 / 10)
    w, p = stats.shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert w == pytest.approx(0.79, abs=0.01) and p == pytest.approx(0.0067, abs=0.001)


def test_motifs():
    m = motifs.Motif.from_text("TGASTCA")
    assert m.consensus.upper() == "TGASTCA" and m.reverse().consensus.upper() == "TGASTCA"
    hits = m.scan("AATGACTCATT")
    assert [(h[0], h[1]) for h in hits] == [(2, 9)] and m.scan("AC") == []
    assert m.best_words(m.best - 0.01)[0][0] in ("TGACTCA", "TGAGTCA")
    assert words.unique_words(2) == ["AA", "AC", "AG", "AT", "CA", "CC", "CG", "GA", "GC", "TA"]
    assert cluster.sliding(m, m.part(1, 9))[0] < 0.2
    merges = cluster.upgma([m, motifs.Motif.from_text("TGACTCA"), motifs.Motif.from_text("GGGCCC")])
    assert {merges[0][1], merges[0][2]} == {0, 1} and cluster.newick(merges, ["a", "b", "c"]).count("(") == 2
    assert cluster.distinct_motifs([(m, 1.0), (m, 2.0)], 0.1) == [1]
    d = np.abs(np.subtract.outer([0, 1, 2, 10, 11], [0, 1, 2, 10, 11])).astype(float)
    assert cluster.k_medoids(d, 2, 1)[0] == [1, 3] or cluster.k_medoids(d, 2, 1)[0] == [1, 4]


def test_clonotypes_are_whole(spark):
    """Queries of clonotypes tell apart CDR3 that share their first letters; rarefaction goes on to the total."""
    whole = {r.cdr3: r.cnt for r in catalog.derived(spark, SF, "clone_seqs").where("length(cdr3) > 0").groupBy("cdr3").agg(F.count("*").alias("cnt")).collect()}
    last = max(catalog.QUERIES["w3_cumulative"](spark, SF).collect(), key=lambda r: r.upto)
    assert last.upto == sum(whole.values()) and last.aa == max(whole)
    curve = {r.n: r.expected for r in catalog.QUERIES["d1_rarefaction"](spark, SF).collect()}
    assert curve[sum(whole.values())] == len(whole) > len({k[:3] for k in whole})
    counts = spark.createDataFrame(list(whole.items()), "aa string, cnt long")
    want = {tuple(r) for r in catalog.diversity.sampled_richness(counts, "aa", 100, [1, 2, 3]).collect()}
    assert {tuple(r) for r in catalog.QUERIES["d1_sampled_richness"](spark, SF).collect()} == want


def test_upstream(spark):
    d = spark.createDataFrame([("q1", "IGHV1-1*01", "forward", 3, 13, "ATGCCCGGGTTTAAACCC"), ("q2", "IGHV1-1*01", "forward", 4, 13, "A"), ("q3", "IGHV1-1*01", "forward", 3, 4, "ACGTACGT")], "queryid string, vgene string, strand string, vstart int, vqstart int, seq string")
    got = upstream.extract(d, 1, 6).collect()
    assert [(r.id, r.upstream) for r in got] == [("q1|IGHV1-1*01", "CCGGGT")]


FR = "CAGGTGCAGCTGGTGGAGTCTGGGGGAGGC"
END = "TGGGGCCAGGGCACCCTGGTCACCGTCTCCTCA"
SPANS = {f"{r}_{x}": v for r, ends in {"fr1": (1, 75), "cdr1": (76, 99), "fr2": (100, 150), "cdr2": (151, 174), "fr3": (175, 219)}.items() for x, v in zip(("start", "end"), ends, strict=True)}
GAPS = {f"{r}_{x}": 0 for r in ("fr1", "cdr1", "fr2", "cdr2", "fr3g", "cdr3g") for x in ("gaps", "mismatches")}
READ = {"queryid": "q", "vgene": "IGHV1-1*01", "chain": "VH", "strand": "forward", "seq": FR * 7 + "TGTGCGAGA" + "GATTACTACGGT" + END, "vqstart": 1, "vstart": 1, "jqend": 250, "v_j_frame": "In-frame", "stopcodon": "No", "vmismatches": 0, "vgaps": 0, **SPANS, **GAPS}


def test_refinement(spark):
    """One read for each flag and outcome; the first one has none."""
    late = END.replace("TGGGGCCAGGGC", "CTCCTCAACGCA")  # neither consensus is met without a gap
    cases = {
        "plain": {}, "reversed": {"seq": S_reverse(READ["seq"]), "strand": "reversed"}, "na": {"v_j_frame": "N/A"}, "out": {"v_j_frame": "Out-of-frame", "fr1_gaps": 1},
        "conc": {"vstart": 9}, "indel": {"cdr1_gaps": 1}, "whole_indel": {"cdr1_gaps": 3}, "no_count": {"fr2_gaps": None}, "no_cdr3_count": {"cdr3g_gaps": None},
        "stop": {"seq": READ["seq"].replace("TGTGCGAGA", "TGTTAAAGA")}, "no_fr4": {"seq": FR * 7 + "TGTGCGAGA"}, "apart": {"cdr1_end": 105},
        "front": {"vqstart": 4, "vstart": 4, "fr1_start": 4}, "gapped_front": {"vqstart": 1, "vstart": 4}, "start": {"fr1_start": 2}, "light": {"chain": "VK", "vgene": "IGKV1-1*01"},
        "dna": {"seq": FR * 7 + "TGTGCGAGA" + "C" * 9}, "late": {"seq": READ["seq"].replace(END, late)},
    }
    schema = spark.createDataFrame([READ]).schema
    frame = spark.createDataFrame([READ | {"queryid": n} | c for n, c in cases.items()], schema)
    got = {r.queryid: r for r in refine.refine(frame).collect()}
    flags = {n: set(r.flags) for n, r in got.items()}
    r = got["plain"]
    assert (r.fr4_start, r.fr4_end, r.cdr3_start, r.cdr3_end) == (232, 264, 220, 231) and r.fr4 == "WGQGTLVTVSS" and r.cdr3 == "DYYG" and r.v_j_frame == "In-frame" and not r.flags
    assert not flags["reversed"] and got["reversed"].cdr3 == "DYYG" and not flags["whole_indel"] and not flags["no_cdr3_count"]
    assert flags["na"] == {"updatedInFrameNA", "updatedInFrame"} and not flags["out"] and got["out"].v_j_frame == "Out-of-frame"
    assert {"updatedInFrameConc", "updatedInFrame"} <= flags["conc"] and flags["indel"] == flags["no_count"] == {"updatedInFrameIndel", "updatedInFrame"}
    assert flags["stop"] == {"endsWithStopCodon", "updatedStopCodon"} and got["stop"].stopcodon == "Yes"
    assert flags["no_fr4"] == {"FR4PredictedError", "updatedInFrameNo3or4", "updatedInFrame"} and got["no_fr4"].fr1 is None and got["no_fr4"].cdr3_end == 250
    assert "partitioning" in flags["apart"] and got["apart"].fr4 is None
    r = got["front"]
    assert (r.vstart, r.vqstart, r.vmismatches, r.fr1_mismatches, r.vgaps) == (1, 1, 3, 3, 0) and "fr1NotAtBegin" not in r.flags
    r = got["gapped_front"]
    assert (r.vgaps, r.fr1_gaps, r.vmismatches, r.vstart, r.vqstart) == (3, 3, 0, 4, 1) and "updatedInFrameConc" in r.flags
    assert flags["start"] == {"fr1NotAtBegin"} and got["light"].chain == "VK" and flags["light"]
    assert {"CDR3dna", "updatedInFrame"} <= flags["dna"] and got["dna"].fr4_start > 219  # nothing in the protein is like FR4
    assert flags["late"] and set().union(*flags.values()) <= set(refine.FLAGS) and len(refine.FLAGS) == 17
    counts = {r.flag: r.cnt for r in refine.flag_counts(refine.refine(frame)).collect()}
    assert counts == {f: sum(f in x for x in flags.values()) for f in set().union(*flags.values())}
    assert {r.flag for r in refine.flag_examples(refine.refine(frame)).collect()} == set(counts)


def test_refinement_of_joined_reads(spark, monkeypatch):
    """Reads looked at once a frame give what rows with their reads give, and few rows are aligned by themselves."""
    end = END.replace("GGGACC", "GGCACC")
    texts = [READ["seq"], S_reverse(READ["seq"]), "AC" + READ["seq"] + FR + end, FR * 9, FR * 7, FR * 5, "ACGT", "", None, FR[:14] + READ["seq"][:225] + END + FR * 3]
    reads = spark.createDataFrame(list(enumerate(texts)), "read_id long, seq string")
    rows = [{k: v for k, v in READ.items() if k != "seq"} | {"read_id": i, "queryid": f"{i}-{q}-{s}-{c}", "vqstart": q, "strand": s, "chain": c, "fr3_end": e} for i in range(len(texts) + 1) for q in (1, 2, 3, 5, 12, None) for s, c in (("forward", "VH"), ("reversed", "VH"), ("forward", "VK")) for e in (219, 222, 1, None)]
    schema = spark.createDataFrame([READ]).drop("seq").schema.add("read_id", "long")
    frame = spark.createDataFrame(rows, schema)
    whole = refine.refine(frame.join(reads, "read_id"))
    alone = []
    old = refine.refine
    monkeypatch.setattr(refine, "refine", lambda r, *a: (alone.append(r), old(r, *a))[1])
    got = refine.refine_reads(frame, reads)
    names = [c for c in whole.columns if c not in ("seq", "read")]
    assert set(got.columns) == set(names)
    assert sorted(map(repr, got.select(*sorted(names)).collect())) == sorted(map(repr, whole.select(*sorted(names)).collect()))
    assert 0 < alone[0].where("chain = 'VH'").count() < frame.where("chain = 'VH'").count()


def S_reverse(seq):
    return seq.translate(str.maketrans("ACGT", "TGCA"))[::-1]


def test_refinement_of_read_ends(spark):
    tail = "GCCTCCACCAAGGGCCCATCG"
    frame = spark.createDataFrame([READ | {"queryid": "a", "seq": READ["seq"] + tail}, READ | {"queryid": "b", "chain": "*"}])
    whole = {r.queryid: r for r in refine.refine(frame, cut=False, trim3=3).collect()}
    assert whole["a"].fr4_end == 264 + len(tail) - 3 and whole["b"].chain == "VH" and whole["b"].fr4_end == 261
    ended = {r.queryid: r for r in refine.refine(frame, cut=False, trim3=[tail[:15]]).collect()}
    assert ended["a"].fr4_end == 231 + len(END) + 1 and "FR4cutEarly" not in ended["a"].flags
    early = {r.queryid: r for r in refine.refine(frame.withColumn("jqend", F.lit(400)), cut=False, trim3=[tail[:15]]).collect()}
    assert "FR4cutEarly" in early["a"].flags and early["a"].fr4_end == 264
    given = refine.refine(frame.where("queryid = 'a'"), qstart=1).first()
    assert given.offset == 1 and {"updatedInFrameConc", "updatedInFrame"} <= set(given.flags)
    twice = refine.mark_lengths(refine.refine(spark.createDataFrame([READ | {"queryid": str(i), "jgene": "IGHJ1*01"} for i in range(3)] + [READ | {"queryid": "x", "jgene": "IGHJ1*01", "fr2_end": 147, "cdr2_start": 148}])))
    assert {r.queryid for r in twice.collect() if "filterFRLength" in r.flags} == {"x"}


def test_texts_of_any_length(spark):
    """Codons and k-mers of a text that spans several blocks, and of none."""
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("ACGTN"), 1000))
    d = spark.createDataFrame([(text,), ("",), ("AC",), (None,)], "s string")
    got = d.select(S.kmers(F.col("s"), 5).alias("k"), S.translate_dna(F.col("s")).alias("p")).collect()
    assert got[0].k == [text[i : i + 5] for i in range(996)] and got[1].k == got[2].k == [] and got[3].k is None
    assert got[0].p == "".join(S.CODONS.get(text[i : i + 3], "X") for i in range(0, 999, 3)) and got[1].p == got[2].p == "" and got[3].p is None
    assert [r.s for r in S.plain_sequences(d, "s").collect()] == ["", "AC"]


def test_samples_and_marks(spark):
    seqs = diversity.random_sequences(spark, 200, 50, {"A": 0.7, "C": 0.1, "G": 0.1, "T": 0.1}, 3)
    made = [r.seq for r in seqs.collect()]
    assert len(set(made)) == 200 and {len(x) for x in made} == {50} and 0.6 < sum(x.count("A") for x in made) / 10000 < 0.8
    assert all("TTTTTTT" in r.seq for r in diversity.planted(seqs, "TTTTTTT").collect())
    counts = spark.createDataFrame([(f"c{i}", 1000 if i < 3 else 1) for i in range(300)], "aa string, cnt long")
    assert {"c0", "c1", "c2"} <= {r.aa for r in diversity.weighted_sample(counts, 30).collect()}
    at = hts.nearest(spark.createDataFrame([("p", "1", 5), ("q", "1", 99), ("r", "2", 1)], "id string, chrom string, pos long"), spark.createDataFrame([("1", 3), ("1", 50)], "chrom string, mark long"))
    assert {(r.id, r.distance) for r in at.collect()} == {("p", 2), ("q", 49)}
    probes = spark.createDataFrame([("a", 10), ("b", 20), ("c", 5)], "probe_id string, length int")
    near = spark.createDataFrame([("a", "b", 20), ("b", "a", 10), ("a", "gone", 99)], "probe_id string, other string, length int")
    assert {r.probe_id for r in search.similar_probes(probes, near).collect()} == {"b", "c"}
    pfm = spark.createDataFrame([("g", 0, "A", 9), ("g", 0, "C", 1), ("g", 1, "A", 5), ("g", 1, "G", 5), ("g", 2, "A", 4), ("g", 2, "C", 3), ("g", 2, "T", 3), ("g", 3, "A", 3), ("g", 3, "C", 3), ("g", 3, "G", 2), ("g", 3, "T", 2)], "gene string, pos int, letter string, cnt long")
    assert [r.letter for r in motifs.degenerate_consensus(pfm, "gene").orderBy("pos").collect()] == ["A", "R", "H", "N"]


RECORD = "\n".join([
    " 2.6.0", "# Query: read1 extra", "# V-(D)-J rearrangement summary for query sequence (a, b).", "IGHV1-1*01,IGHV1-1*02\tIGHD1-1*01\tIGHJ4*02\tVH\tNo\tIn-frame\tYes\t+",
    "# Sub-region sequence details (x)", "CDR3\tTGT\tCAR\t286\t300", "# Alignment summary between query and top germline V gene hit (x)", "FR1\t1\t75\t75\t75\t0\t0\t100", "CDR1\t76\t99\t24\t23\t1\t0\t95.8", "FR3\t175\t285\t111\t110\t1\t0\t99", "Total\tN/A\tN/A\t285",
    "# Hit table", "# Fields: query id, subject id", "# 2 hits found", "V\tread1\tIGHV1-1*01\t99.0\t285\t2\t0\t0\t1\t285\t1\t285\t1e-80\t440", "J\tread1\tIGHJ4*02\t100\t40\t0\t0\t0\t310\t349\t1\t40\t1e-20\t80",
])


def test_alignment_reports(spark, tmp_path):
    path = tmp_path / "out.txt"
    path.write_text("# IGBLASTN" + RECORD + "\n# IGBLASTN 2.6.0\n# Query: read2\n# 0 hits found\n")
    got = {r.queryid: r for r in reports.read_annotations(spark, str(path)).collect()}
    r = got["read1"]
    assert (r.vgene, r.dgene, r.jgene, r.strand, r.vstart, r.bitscore, r.fr1_end, r.fr3_end, r.cdr3_start, r.jqend, r.unmapped) == ("IGHV1-1*01", "IGHD1-1*01", "IGHJ4*02", "forward", 1, 440.0, 75, 285, 286, 349, False)
    assert got["read2"].unmapped and got["read2"].vgene is None


def test_sequence_files(spark, tmp_path):
    (tmp_path / "s_R1.fasta").write_text(">a one\nACGT\nAC\n>b two\nGG\n")
    (tmp_path / "s_R1.fastq").write_text("@a x\nACGT\n+\n@@II\n@b\nGG\n+\nII\n")
    fasta, fastq = (files.read_sequences(spark, str(tmp_path / f"s_R1.{x}")) for x in ("fasta", "fastq"))
    assert {(r.read_id, r.seq) for r in fasta.collect()} == {("a", "ACGTAC"), ("b", "GG")}
    assert {(r.read_id, r.seq, r.qual) for r in fastq.collect()} == {("a", "ACGT", "@@II"), ("b", "GG", "II")}
    assert files.sample_name("x/s_R1.fasta", True) == "s" and files.quality_by_position(fastq).count() == 4
    pair = spark.createDataFrame([("a", "AAAACCCCGGGGTTTTACGTA")], "read_id string, seq string"), spark.createDataFrame([("a", "CCCCCCTACGTAAAACCCCGGGG")], "read_id string, seq string")
    assert files.merge_pairs(*pair, overlap=15).first().seq == "AAAACCCCGGGGTTTTACGTAGGGGGG"
    sinks.write_fasta(fasta, str(tmp_path / "out"), width=4)
    assert files.read_fasta(spark, str(tmp_path / "out")).where("read_id = 'a'").first().seq == "ACGTAC"
    sinks.write_report(fasta.select("read_id", "seq").orderBy("read_id"), str(tmp_path / "r.csv"), "vert,total=2")
    assert (tmp_path / "r.csv").read_text().splitlines() == ["vert,total=2", "read_id,seq", "a,ACGTAC", "b,GG"]
    sinks.write_summary(str(tmp_path / "summary.txt"), RawReads=1)
    sinks.write_summary(str(tmp_path / "summary.txt"), RawReads=2, FilteredReads=1)
    assert (tmp_path / "summary.txt").read_text() == "RawReads:2\nFilteredReads:1\n"


def test_streaming(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.fasta").write_text(">a\nAC\nGT\n>b\nGG\n>a\nTT\n")
    ingest.write_deduplicated(ingest.stream_fasta(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert {r.read_id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"a", "b"}


def test_matrix_and_motif_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("probe,e1,e2\np,0.5,NaN\nq,,2\n")
    assert {(r.experiment, r.probe, r.value) for r in reports.read_matrix(spark, str(tmp_path / "m.csv")).collect()} == {("e1", "p", 0.5), ("e2", "p", 0.9999), ("e1", "q", 0.9999), ("e2", "q", 2.0)}
    (tmp_path / "m.motifs").write_text(sinks.motif_text(motifs.Motif.from_text("ACGT"), 3))
    r = reports.read_motifs(spark, str(tmp_path / "m.motifs")).first()
    assert r.width == 4 and len(r.ratios) == 4 and r.metrics["Width"] == 4
    (tmp_path / "x.pdb").write_text("ATOM      1  CA  ALA A   1      11.104   6.134  -6.504\nATOM      2  CA  GLY A   3      11.104   6.134  -6.504\n")
    assert reports.chain_sequence(reports.read_atoms(spark, str(tmp_path / "x.pdb"))).first().seq == "A.G"
    with pytest.raises(ValueError):
        reports.extract_ranges("5-2")


def test_dimension_tables(spark, tmp_path):
    row = ["", "ORF|Verified", "", "YAL001C", "TFC3", "FUN24|TSV115", "", "", "1", "151006", "147594", "", "", "", "", "a factor"]
    (tmp_path / "features").write_text("\t".join(row) + "\n" + "\t".join(["", "CEN", "", "CEN1", "", "", "", "", "1", "151465", "151582"]) + "\n")
    features = tables.read_features(spark, str(tmp_path / "features"))
    assert [tuple(r) for r in tables.gene_names(features).collect()] == [("TFC3", "YAL001C")] and features.where("orf = 'YAL001C'").first().aliases == ["FUN24", "TSV115"]
    (tmp_path / "lengths").write_text("1\tx\t230208\n")
    ends = hts.end_distance(features.select(F.col("orf").alias("id"), "chrom", "start", "end"), tables.read_chromosomes(spark, str(tmp_path / "lengths")))
    assert {(r.id, r.distance) for r in ends.collect()} == {("YAL001C", 82614), ("CEN1", 78626)}
    (tmp_path / "go").write_text("g1\ta\tb\tP\tcell cycle\ng1\ta\tb\tF\tbinding\ng2\ta\tb\tP\tNOT growth\ng3\ta\tb\tP\tunknown\n")
    assert [tuple(r) for r in tables.read_categories(spark, str(tmp_path / "go"), omit=("unknown",)).collect()] == [("g1", "cell cycle")]
    (tmp_path / "probes").write_text("p1 single A|YAL1 B|YAL2\np2 none\n")
    assert {tuple(r) for r in tables.read_probe_orfs(spark, str(tmp_path / "probes")).collect()} == {("p1", "single", "YAL1"), ("p1", "single", "YAL2")}
    (tmp_path / "levels").write_text("YAL1\t2.5\nYAL2\t#\n")
    assert {(r.orf, r.level) for r in tables.read_expression(spark, str(tmp_path / "levels")).collect()} == {("YAL1", 2.5), ("YAL2", None)}
    chromosomes = spark.createDataFrame([("chr4", "ACGTACGT")], "chrom string, seq string")
    assert tables.chromosome_range(chromosomes, "chr4:2-4").first().seq == "CGT" and tables.chromosome_range(chromosomes, "X:1-2").count() == 0
    with pytest.raises(ValueError):
        tables.chromosome_range(chromosomes, "chr4")


def test_session(spark, tmp_path):
    assert "reads" in session.register_views(spark, SF) and spark.sql("SELECT count(*) AS n FROM reads").first().n == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert "align_dna" in session.register_functions(spark) and spark.sql("SELECT align_dna('TTACGT', 'ACGT').start AS s, best_identity('ACG', 'TTACG') AS i").first() == (3, 3)
    records = spark.createDataFrame([("a", "AC"), ("b", "G"), ("a", "TT")], "read_id string, seq string").coalesce(1)
    assert {tuple(r) for r in files.last_of_each(records).collect()} == {("a", "TT"), ("b", "G")} and files.to_fasta(records).columns == ["read_id", "seq"]
    sinks.write_flags(spark.createDataFrame([("q", ["noFR4", "CDR3dna"])], "queryid string, flags array<string>"), str(tmp_path / "flags"))
    assert {r.flag for r in spark.read.text(str(tmp_path / "flags")).collect()} == {"noFR4", "CDR3dna"}
    (tmp_path / "ids").write_text("# list\nx1\n\nx2 # last\n")
    assert [r.id for r in reports.read_ids(spark, str(tmp_path / "ids")).collect()] == ["x1", "x2"]
    assert reports.read_primers(records.where("read_id = 'b'")) == [("b", "G", 5)]

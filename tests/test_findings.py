"""What a review found: each of these failed before its finding was settled."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paratope import catalog
from paratope.functions import sequences as S
from paratope.operators import intervals, motifs, primer, restriction, upstream


def test_bound_by_takes_every_probe(spark, tmp_path):
    rows = [(1, "view", 9.0), (2, "view", 4.0), (3, "click", 5.0), (3, "click", 7.0), (4, "error", 6.0)]
    spark.createDataFrame(rows, "user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = entry.queries()["f9_bound_by"](spark, str(tmp_path)).collect()
    assert sorted(r.experiment for r in got) == ["click", "view"]


def test_overlaps_of_short_spans_meet_in_fine_bins_only(spark):
    """Before, every two spans of a chromosome met at the coarse levels: here 6.4 billion pairs, which took far over a minute."""
    spans = spark.range(80_000).selectExpr("id", "'x' AS chrom", "id * 20000 AS start", "id * 20000 + 300 AS end")
    began = time.monotonic()
    assert intervals.overlapping(spans, spans).where("id = b_id").count() == 80_000
    assert time.monotonic() - began < 60


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with the first documents and lines of the driver's smallest tables."""
    d = str(tmp_path_factory.mktemp("small"))
    for t, key, most in (("documents", "doc_id", 40), ("lineitem", "l_orderkey", 150)):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").where(f"{key} <= {most}").write.parquet(f"{d}/{t}.parquet")
    return d


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_upstream_takes_ends_of_reads_through_the_join(spark, small):
    whole = upstream.extract(catalog._reads_with_annotation(spark, small), 1, 20)
    assert _rows(catalog._upstream(spark, small)) == _rows(whole) and whole.count()
    ends = S.read_ends(spark.createDataFrame([(1, "AACGT"), (2, "AC"), (3, None)], "read_id long, seq string"), F.lit(3))
    assert _rows(ends.select("read_id", "reversed", "seq").where("read_id < 3")) == _rows(spark.createDataFrame([(1, False, "AAC"), (1, True, "CGT"), (2, False, "AC"), (2, True, "AC")], ends.schema))


@pytest.mark.parametrize("side", ["5", "3"])
def test_primers_are_matched_before_the_join(spark, small, side):
    whole = primer.add_primers(catalog._reads_with_annotation(spark, small), catalog.PRIMERS, side)
    names = ["queryid", *(f"{c}{side}" for c in ("primer", "mismatch", "indel"))]
    got = catalog._with_primers(spark, small, side)
    assert "seq" not in got.columns and _rows(got.select(*names)) == _rows(whole.select(*names))


def test_sites_are_searched_before_the_join(spark, small):
    whole = catalog._reads_with_annotation(spark, small).withColumn("read_id", F.col("queryid"))
    assert _rows(catalog.QUERIES["c9_region_hits"](spark, small)) == _rows(restriction.region_hits(whole, catalog.SITES[:3]))


def test_letters_of_a_group_are_counted_in_one_pass(spark):
    seqs = [("a", "ACG"), ("a", "A-"), ("a", ""), ("a", None), ("b", ""), (None, "T"), (None, "TTT")]
    got = motifs.pfm(spark.createDataFrame(seqs, "g string, seq string"), "g")
    want = [("a", 0, "-", 1), ("a", 0, "A", 2), ("a", 1, "-", 2), ("a", 1, "C", 1), ("a", 2, "-", 2), ("a", 2, "G", 1)]
    want += [(None, 0, "T", 2), (None, 1, "-", 1), (None, 1, "T", 1), (None, 2, "-", 1), (None, 2, "T", 1)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_pairs_of_gene_motifs_do_not_read_the_annotation_again(spark, small):
    grouped, pairs = catalog._gene_pairs(spark, small)
    assert not [f for df in (grouped, pairs) for f in df.inputFiles() if "lineitem" in f or "documents" in f]


@pytest.mark.parametrize("k", [1, 3, 40])
def test_kmers_leave_the_task_counted(spark, k):
    texts = ["acgtn" * 9, "AC", "", None, "A" * 50, "é\U0001f600Z" * 15]
    rows = motifs.kmer_counts(spark.createDataFrame([(t,) for t in texts], "seq string").repartition(2), k)
    want = Counter(t.upper()[i : i + k] for t in texts if t for i in range(len(t) - k + 1))
    assert {r.w: r.cnt for r in rows.collect()} == dict(want)
    assert "Generate" not in rows._jdf.queryExecution().optimizedPlan().toString()  # no row a run

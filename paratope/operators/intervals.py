"""Spans on chromosomes: joins of overlapping ones and unions, by bins, so that no task sees a whole chromosome.

A span is (chrom, start, end) in whole numbers, end exclusive; empty spans and those with a null are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1 << 14  # places of the finest bins
LEVELS = 24  # each level's bins are twice as wide


def _plain(spans: DataFrame) -> DataFrame:
    return spans.where("chrom IS NOT NULL AND start < end")


def overlapping(a: DataFrame, b: DataFrame, within: int = 0, width: int = WIDTH) -> DataFrame:
    """Pairs of a span of ``a`` and one of ``b`` on a chromosome that share a place, or lie ``within`` places of each other: chrom, and the
    other columns of both, those of ``b`` behind ``b_``.

    A span lives at the level whose bins are as wide as it is, in two of them at most, and also visits the bins of those coarser
    levels where spans of the other table live. Two spans meet once, at the coarser one's level in the bin where the later one
    begins: those of ``a`` at home with visitors of ``b`` as wide or less wide, and those of ``b`` at home with less wide ones of ``a``.
    """
    reach = _plain(a).withColumns({"__s": F.col("start") - within, "__e": F.col("end") + within})
    other = _plain(b).select("chrom", *(F.col(c).alias(f"b_{c}") for c in b.columns if c != "chrom"), F.col("start").alias("__t"), F.col("end").alias("__f"))

    def home(df: DataFrame, start: str, end: str) -> DataFrame:
        size = F.col(end) - F.col(start)
        own = F.least(F.greatest(F.ceil(F.log2(size / F.lit(float(width)))), F.lit(0)), F.lit(LEVELS - 1)).cast("int")
        return df.withColumn("__level", own)

    def binned(df: DataFrame, start: str, end: str) -> DataFrame:
        step = F.lit(width) * F.expr("shiftleft(1L, __level)")
        return df.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / step).cast("long"), F.floor((F.col(end) - 1) / step).cast("long"))))

    def visiting(df: DataFrame, hosts: DataFrame, coarser: bool) -> DataFrame:
        """Each row at each level of the hosts' that is its own or a coarser one, or only the latter. There are few levels."""
        levels = F.broadcast(hosts.select(F.col("__level").alias("__at")).distinct())
        met = df.join(levels, F.col("__at") > F.col("__level") if coarser else F.col("__at") >= F.col("__level"))
        return met.drop("__level").withColumnRenamed("__at", "__level")

    ours, theirs = home(reach, "__s", "__e"), home(other, "__t", "__f")
    sides = [(ours, visiting(theirs, ours, coarser=False)), (visiting(ours, theirs, coarser=True), theirs)]
    step = F.lit(width) * F.expr("shiftleft(1L, __level)")
    first = F.floor(F.greatest("__s", "__t") / step) == F.col("__bin")
    near = (F.col("__s") < F.col("__f")) & (F.col("__t") < F.col("__e")) & first
    out = [*a.columns, *(c for c in other.columns if c.startswith("b_"))]
    x, y = (binned(p, "__s", "__e").join(binned(q, "__t", "__f"), ["chrom", "__level", "__bin"]).where(near).select(*out) for p, q in sides)
    return x.unionByName(y)


def _distance(lo: Column, hi: Column, other_lo: Column, other_hi: Column) -> Column:
    return F.greatest(F.lit(0), other_lo - hi + 1, lo - other_hi + 1)


def span_gaps(a: DataFrame, b: DataFrame, within: int, width: int = WIDTH) -> DataFrame:
    """``overlapping`` pairs within a distance, with ``gap``: 0 for spans that share a place, 1 for those that touch, and so on."""
    met = overlapping(a, b, within, width)
    return met.withColumn("gap", _distance(F.col("start"), F.col("end"), F.col("b_start"), F.col("b_end")))


def merged(spans: DataFrame, touch: bool = True, width: int = WIDTH) -> DataFrame:
    """(chrom, start, end, spans): unions of the spans of a chromosome that overlap or, with ``touch``, lie side by side.

    Spans are ordered within bins of their start; what reaches over from earlier bins, and how many unions begin there, are one
    row a bin. Spans that are alike are counted before, so that a hot place is one row.
    """
    bin_ = F.floor(F.col("start") / width).alias("bin")
    alike = _plain(spans).groupBy("chrom", "start", "end").agg(F.count("*").alias("n")).select("*", bin_)
    bins = alike.groupBy("chrom", "bin").agg(F.max("end").alias("far"))
    along = Window.partitionBy("chrom").orderBy("bin")
    bins = bins.select("chrom", "bin", F.max("far").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("past"))
    own = Window.partitionBy("chrom", "bin").orderBy("start", "end")
    before = F.greatest(F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.col("past"))
    begins = F.coalesce(F.col("start") > before if touch else F.col("start") >= before, F.lit(True)).cast("int")
    rows = alike.join(bins, ["chrom", "bin"]).withColumn("new", begins).withColumn("count", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    made = rows.groupBy("chrom", "bin").agg(F.sum("new").alias("made")).select("chrom", "bin", (F.sum("made").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("made")).alias("base"))
    named = rows.join(made, ["chrom", "bin"]).withColumn("union", F.col("base") + F.col("count"))
    return named.groupBy("chrom", "union").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("spans")).drop("union")


def neighbourhoods(sites: DataFrame, probes: DataFrame, flank: int) -> DataFrame:
    """(probe_id, start, end, spans, text): the stretches of probes (probe_id, seq) within ``flank`` letters of a site (probe_id, start,
    end), those that overlap or touch as one."""
    size = probes.select("probe_id", F.length("seq").alias("size"))
    wide = sites.join(size, "probe_id").select(F.col("probe_id").alias("chrom"), F.greatest(F.lit(0), F.col("start") - flank).alias("start"), F.least(F.col("size"), F.col("end") + flank).alias("end"))
    out = merged(wide).withColumnRenamed("chrom", "probe_id")
    return out.join(probes.select("probe_id", "seq"), "probe_id").select("probe_id", "start", "end", "spans", F.expr("substring(seq, cast(start as int) + 1, cast(end - start as int))").alias("text"))

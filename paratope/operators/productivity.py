"""Productivity: classes of reads, gap and mismatch distributions, framework lengths and their consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paratope.functions.sequences import gene
from paratope.operators.abundance import with_share


def classes(annot: DataFrame) -> DataFrame:
    """(productivity, reason, cnt, pct): shares are of all rows, so rows with another frame value make the sum less than 100."""
    in_frame, out, stop = F.col("v_j_frame") == "In-frame", F.col("v_j_frame") == "Out-of-frame", F.col("stopcodon") == "Yes"
    one = annot.agg(
        F.count("*").alias("total"),
        F.count_if(in_frame & ~stop).alias("a"), F.count_if(in_frame & stop).alias("b"), F.count_if(out & ~stop).alias("c"), F.count_if(out & stop).alias("d"),
    )
    rows = one.selectExpr("total", "stack(4, 'Productive', '-', a, 'Unproductive', 'Stopcodon', b, 'Unproductive', 'Out-of-Frame', c, 'Unproductive', 'Both', d) AS (productivity, reason, cnt)")
    return rows.select("productivity", "reason", "cnt", F.round(F.try_divide(100.0 * F.col("cnt"), F.col("total")), 6).alias("pct"))


def distributions(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, value, cnt, pct) of several columns in one pass; a missing value is the class ``NaN``."""
    long = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("NaN")).alias(c) for c in columns)).unpivot([], columns, "metric", "value")
    return with_share(long.groupBy("metric", "value").agg(F.count("*").alias("cnt")), ["metric"])


def framework_lengths(annot: DataFrame) -> DataFrame:
    """(gene, region, len, cnt): fr1 to fr3 by V gene, fr4 by J gene, of reads in frame."""
    one = lambda r, g: F.struct(F.lit(r).alias("region"), gene(F.col(g)).alias("gene"), (F.col(f"{r}_end") - F.col(f"{r}_start") + 1).alias("len"))
    rows = annot.where("v_j_frame = 'In-frame'").select(F.inline(F.array(one("fr1", "vgene"), one("fr2", "vgene"), one("fr3", "vgene"), one("fr4", "jgene"))))
    return rows.where("gene IS NOT NULL AND len IS NOT NULL").groupBy("gene", "region", "len").agg(F.count("*").alias("cnt"))


def consensus(lengths: DataFrame) -> DataFrame:
    """The commonest length of each gene and region, the shortest on a tie."""
    best = F.row_number().over(Window.partitionBy("gene", "region").orderBy(F.desc("cnt"), "len"))
    return lengths.withColumn("rn", best).where("rn = 1").select("gene", "region", "len")


def mark_filtered(annot: DataFrame) -> DataFrame:
    """``annot`` with filtered = 'No' where a read is in frame and all its framework lengths are the consensus, else 'Yes'."""
    agreed = consensus(framework_lengths(annot))
    # One row a gene, so that a read meets its V and its J gene once each.
    wide = lambda names, key: agreed.where(F.col("region").isin(names)).groupBy(F.col("gene").alias(key)).agg(*(F.max(F.when(F.col("region") == r, F.col("len"))).alias(f"__{r}") for r in names))
    out = annot.join(wide(["fr1", "fr2", "fr3"], "__v"), gene(F.col("vgene")) == F.col("__v"), "left").join(wide(["fr4"], "__j"), gene(F.col("jgene")) == F.col("__j"), "left").drop("__v", "__j")
    fits = [F.coalesce((F.col(f"{r}_end") - F.col(f"{r}_start") + 1) == F.col(f"__{r}"), F.col(f"{r}_end").isNull() | F.col(f"{r}_start").isNull()) for r in ("fr1", "fr2", "fr3", "fr4")]
    ok = (F.col("v_j_frame") == "In-frame") & fits[0] & fits[1] & fits[2] & fits[3]
    return out.withColumn("filtered", F.when(ok, "No").otherwise("Yes")).drop("__fr1", "__fr2", "__fr3", "__fr4")


REGIONS = ["fr1", "cdr1", "fr2", "cdr2", "fr3", "cdr3", "fr4"]


def stops_by_frame(annot: DataFrame, seqs: DataFrame, key: str = "queryid") -> DataFrame:
    """(frame, region, cnt): reads in and out of frame with a stop codon in the region."""
    rows = annot.where("v_j_frame IN ('In-frame', 'Out-of-frame')").select(key, F.col("v_j_frame").alias("frame")).distinct().join(seqs, key)
    sums = rows.groupBy("frame").agg(*(F.count_if(F.contains(F.col(r), F.lit("*"))).alias(r) for r in REGIONS))
    return sums.unpivot(["frame"], REGIONS, "region", "cnt")


def stops_by_region(seqs: DataFrame, regions: list[str] = REGIONS) -> DataFrame:
    """(region, cnt): reads with a stop codon in the region."""
    sums = seqs.agg(*(F.count_if(F.contains(F.col(r), F.lit("*"))).alias(r) for r in regions))
    return sums.unpivot([], regions, "region", "cnt")


def frame_shift(expected: Column, start: Column, end: Column) -> Column:
    return (end - start + 1 - expected) % 3

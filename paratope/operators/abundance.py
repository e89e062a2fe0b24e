"""Gene abundance: counts and shares by allele, gene and family, and the V family by J gene table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paratope.functions.sequences import family, gene
from paratope.operators.running import running_sums


def shares(df: DataFrame, *keys: str | Column, within: list[str] | None = None) -> DataFrame:
    """Counts of each key and their percentage of all rows (of the group ``within``)."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("cnt"))
    return with_share(counts, within)


def with_share(counts: DataFrame, within: list[str] | None = None) -> DataFrame:
    if within:
        return counts.withColumn("pct", F.round(100.0 * F.col("cnt") / F.sum("cnt").over(Window.partitionBy(*within)), 6))
    # One row that is broadcast beats a window without partitions, which would take all rows to one task.
    total = counts.agg(F.sum("cnt").alias("total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("pct", F.round(100.0 * F.col("cnt") / F.col("total"), 6)).drop("total")


def by_level(annot: DataFrame, column: str) -> DataFrame:
    """(level, name, cnt, pct) of a gene column's alleles, genes and families in one pass, by grouping sets."""
    rows = annot.where(F.col(column).isNotNull()).select(F.col(column).alias("variant"), gene(F.col(column)).alias("gene"), family(F.col(column)).alias("family"))
    sets = rows.groupingSets([["variant"], ["gene"], ["family"]], "variant", "gene", "family").agg(F.count("*").alias("cnt"), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 3, "variant").when(F.col("g") == 5, "gene").otherwise("family")
    named = sets.select(level.alias("level"), F.coalesce("variant", "gene", "family").alias("name"), "cnt")
    return with_share(named, ["level"])


def roll_up(counts: DataFrame, to: Column) -> DataFrame:
    """Counts by name added up to a coarser name."""
    return counts.groupBy(to.alias("name")).agg(F.sum("cnt").alias("cnt"))


def vj_association(annot: DataFrame) -> DataFrame:
    """Reads by V family and J gene; names of under five characters are left out."""
    named = annot.where((F.length("vgene") >= 5) & (F.length("jgene") >= 5))
    return named.groupBy(family(F.col("vgene")).alias("v"), gene(F.col("jgene")).alias("j")).agg(F.count("*").alias("value"))


def histogram(df: DataFrame, value: Column, max_value: int | None = None, outliers: bool = True) -> DataFrame:
    """(value, cnt); without outliers only values within four weighted standard deviations of the mean."""
    counts = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("cnt"))
    if max_value is not None:
        counts = counts.where(F.col("value") <= max_value)
    if outliers:
        return counts
    v, w = F.col("value").cast("double"), F.col("cnt")
    s = counts.agg(F.sum(w).alias("w"), F.sum(w * v).alias("x"), F.sum(w * v * v).alias("xx"))
    s = s.select((F.col("x") / F.col("w")).alias("mean"), F.sqrt(F.greatest(F.col("xx") / F.col("w") - F.pow(F.col("x") / F.col("w"), 2), F.lit(0.0))).alias("sd"))
    return counts.crossJoin(F.broadcast(s)).where(F.abs(v - F.col("mean")) <= 4 * F.col("sd")).select("value", "cnt")


def heatmap(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """(bx, by, cnt, pct) of a two-dimensional histogram; the largest value falls in the last bin."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    ends = rows.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    cell = lambda v, lo, hi: F.coalesce(F.least(F.floor(F.try_divide(F.col(v) - F.col(lo), F.col(hi) - F.col(lo)) * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    return with_share(rows.crossJoin(F.broadcast(ends)).groupBy(cell("x", "x0", "x1").alias("bx"), cell("y", "y0", "y1").alias("by")).agg(F.count("*").alias("cnt")))


def top(counts: DataFrame, n: int, name: str, rare: bool = False) -> DataFrame:
    """The n most (or least) frequent names, with shares of the whole; ties by name."""
    return with_share(counts).orderBy(F.col("cnt") if rare else F.desc("cnt"), name).limit(n)


def placed(rows: DataFrame, value: str, by_count: bool = False, order: list[tuple[str, bool]] | None = None) -> DataFrame:
    """``rows`` with their place from 1 in an order: of ``value``, of ``cnt`` from the highest on (ties by value), or of columns, each
    ascending or not. The order must tell rows apart. Places are running sums by ranges, so no task sees all rows."""
    order = order or ([("cnt", False), (value, True)] if by_count else [(value, True)])
    keys = [F.asc(c) if up else F.desc(c) for c, up in order]
    return running_sums(rows.withColumn("__one", F.lit(1)), keys, "__one", "place").drop("__one")

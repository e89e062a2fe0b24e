"""Probe by experiment matrices in long form (experiment, probe, value), gene lookups and category enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paratope.functions.stats import hypergeometric_tail_udf


def at_most(hts: DataFrame, experiment: str, threshold: float) -> DataFrame:
    """Probes bound (or underexpressed) in an experiment."""
    return hts.where((F.col("experiment") == experiment) & (F.col("value") <= threshold)).select("probe")


def at_least(hts: DataFrame, experiment: str, threshold: float) -> DataFrame:
    """Probes overexpressed in an experiment."""
    return hts.where((F.col("experiment") == experiment) & (F.col("value") >= threshold)).select("probe")


def bound_in_all(hts: DataFrame, patterns: list[str], threshold: float) -> DataFrame:
    """Probes that pass in every experiment that matches a pattern: value <= threshold, or >= for a pattern behind ``~``."""
    out = None
    for p in patterns:
        high = p.startswith("~")
        rows = hts.where(F.col("experiment").rlike(p.removeprefix("~")))
        good = rows.groupBy("probe").agg(F.bool_and(F.col("value") >= threshold if high else F.col("value") <= threshold).alias("ok")).where("ok").select("probe")
        out = good if out is None else out.join(good, "probe", "left_semi")
    return out


def experiments(hts: DataFrame, pattern: str) -> DataFrame:
    return hts.where(F.col("experiment").rlike(pattern)).select("experiment").distinct()


def extremes(hts: DataFrame, experiment: str, n: int, lowest: bool = False, threshold: float | None = None) -> DataFrame:
    """The n highest (lowest) probes of an experiment, then only those beyond the threshold; ties by probe."""
    rows = hts.where(F.col("experiment") == experiment).orderBy(F.col("value") if lowest else F.desc("value"), "probe").limit(n)
    if threshold is not None:
        rows = rows.where(F.col("value") <= threshold if lowest else F.col("value") >= threshold)
    return rows.select("probe", "value")


def selected(hts: DataFrame, bad: DataFrame | None = None, top: int | None = None, ratio: float | None = None, most: float | None = None, spared: int = 2) -> DataFrame:
    """(experiment, probe, value, place) of each experiment's probes: the ``top`` of least value (ties by probe), those of at least
    ``ratio``, or those of at most ``most``; from the least value on. ``bad`` probes (probe) go where more than ``spared`` would.

    The top of an experiment is kept by each task before it is shuffled, so no task sorts a whole experiment for it.
    """
    order = Window.partitionBy("experiment").orderBy("value", "probe")
    rows = hts.select("experiment", "probe", "value").where("value IS NOT NULL")
    if top is not None:
        rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).drop("place")
    elif ratio is not None:
        rows = rows.where(F.col("value") >= ratio)
    elif most is not None:
        rows = rows.where(F.col("value") <= most)
    if bad is not None:
        marked = rows.join(bad.select("probe").distinct().withColumn("bad", F.lit(True)), "probe", "left")
        many = marked.groupBy("experiment").agg(F.count("bad").alias("gone")).where(F.col("gone") > spared).select("experiment", F.lit(True).alias("strict"))
        rows = marked.join(many, "experiment", "left").where("bad IS NULL OR strict IS NULL").select("experiment", "probe", "value")
    return rows.withColumn("place", F.row_number().over(order))


def rank_pvalue(hts: DataFrame, experiment: str, observed: float) -> DataFrame:
    """Share of values above the observed one, taking at least one to be so."""
    one = hts.where(F.col("experiment") == experiment).agg(F.count_if(F.col("value") > observed).alias("k"), F.count("*").alias("n"))
    return one.select(F.round(F.try_divide(F.greatest("k", F.lit(1)), F.col("n")), 9).alias("p"))


def lookup(rows: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """``rows`` with the mapped name of a key, or the key itself where it isn't mapped; ``mapping`` is (key, mapped)."""
    return rows.join(mapping.select(key, "mapped"), key, "left").withColumn("mapped", F.coalesce("mapped", key))


def enrichment(genes: DataFrame, annotation: DataFrame, bonferroni: bool = True) -> DataFrame:
    """(category, found, size, p): upper hypergeometric tail of each category among the genes, times the number of categories."""
    a = annotation.select("gene", "category").distinct()
    total = a.agg(F.count_distinct("gene").alias("total"), F.count_distinct("category").alias("categories"))
    mine = genes.select("gene").distinct().withColumn("own", F.lit(1))
    marked = a.join(mine, "gene", "left")
    draws = marked.where("own = 1").agg(F.count_distinct("gene").alias("draws"))
    per = marked.groupBy("category").agg(F.count("own").alias("found"), F.count("*").alias("size")).where("found > 0")
    rows = per.crossJoin(F.broadcast(total)).crossJoin(F.broadcast(draws))
    p = hypergeometric_tail_udf("found", "draws", "size", "total")
    return rows.select("category", "found", "size", F.least(F.lit(1.0), p * (F.col("categories") if bonferroni else F.lit(1))).alias("p"))


def category_sizes(annotation: DataFrame) -> DataFrame:
    """(size, categories): how many categories have so many genes."""
    return annotation.groupBy("category").agg(F.count_distinct("gene").alias("size")).groupBy("size").agg(F.count("*").alias("categories"))


def nearest(positions: DataFrame, marks: DataFrame, width: int = 1 << 17) -> DataFrame:
    """Distance from each (id, chrom, pos) to the nearest mark (chrom, mark) of its chromosome, chromosomes without one left out.

    A chromosome is cut into bins of ``width`` places. Within a bin the nearest is the last mark before or the first one after; where
    a bin has none there, it is the last of the bins before or the first of those after. Each place is looked at once, however many
    rows lie there, so a task's group has ``width`` places at most.
    """
    bin_ = F.floor(F.col("at") / width).alias("bin")
    places = positions.select("chrom", F.col("pos").cast("long").alias("at")).where("at IS NOT NULL").distinct()
    known = marks.select("chrom", F.col("mark").cast("long").alias("at")).where("at IS NOT NULL").distinct()
    both = places.withColumn("mark", F.lit(None).cast("long")).unionByName(known.withColumn("mark", F.col("at"))).select("*", bin_)
    bins = both.groupBy("chrom", "bin").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    along = Window.partitionBy("chrom").orderBy("bin")
    bins = bins.select("chrom", "bin", F.max("high").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("past"), F.min("low").over(along.rowsBetween(1, Window.unboundedFollowing)).alias("next"))
    by = Window.partitionBy("chrom", "bin").orderBy("at")
    before = F.max("mark").over(by.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min("mark").over(by.rangeBetween(0, Window.unboundedFollowing))
    found = both.withColumns({"before": before, "after": after}).where("mark IS NULL").join(bins, ["chrom", "bin"])
    gap = F.least(F.col("at") - F.coalesce("before", "past"), F.coalesce("after", "next") - F.col("at"))
    found = found.select(F.col("chrom").alias("__c"), F.col("at").alias("__p"), gap.alias("distance")).where("distance IS NOT NULL")
    return positions.join(found, (F.col("chrom") == F.col("__c")) & (F.col("pos") == F.col("__p"))).select("id", "chrom", "pos", "distance")


def span_distance(a_start, a_end, b_start, b_end):
    """The least distance of the ends of two spans, as a column."""
    return F.least(*(F.abs(F.col(x) - F.col(y)) for x in (a_start, a_end) for y in (b_start, b_end)))


def end_distance(spans: DataFrame, lengths: DataFrame) -> DataFrame:
    """(id, chrom, start, end) with the distance to the nearer end of the chromosome (chrom, length)."""
    return spans.join(F.broadcast(lengths), "chrom").withColumn("distance", F.least("start", F.col("length") - F.col("end"))).drop("length")


def values(hts: DataFrame, experiment: str, probes: DataFrame | None = None) -> DataFrame:
    """(probe, value) of an experiment; an underscore in its name stands for a space as well. With several data sets (column
    ``dataset``, a number) the first one that holds the experiment counts."""
    rows = hts.where(F.translate("experiment", "_", " ") == experiment.replace("_", " "))
    if "dataset" in hts.columns:
        first = rows.agg(F.min("dataset").alias("dataset"))
        rows = rows.join(F.broadcast(first), "dataset")
    return (rows if probes is None else rows.join(probes.select("probe"), "probe", "left_semi")).select("probe", "value")


def bound_by(hts: DataFrame, probe: str | None, threshold: float) -> DataFrame:
    """Experiments in which a probe is bound; without a probe, a row for each probe that is bound."""
    own = F.lit(True) if probe is None else F.col("probe") == probe
    return hts.where(own & (F.col("value") <= threshold)).select("experiment")


def matching_probes(probes: DataFrame, regex: str) -> DataFrame:
    """(probe_id) of the probes whose forward strand matches a raw regular expression."""
    return probes.where(F.upper("seq").rlike(regex)).select("probe_id")


def stringent(probes: DataFrame, most: int = 2) -> DataFrame:
    """Probes without a failed PCR (column ``bad``) and with at most so many positions on the array."""
    return probes.where(~F.coalesce("bad", F.lit(False)) & (F.coalesce("positions", F.lit(0)) <= most))


def categories(annotation: DataFrame) -> DataFrame:
    """(category, genes, members): genes of each category, their names in order as one text."""
    return annotation.select("gene", "category").distinct().groupBy("category").agg(F.count("*").alias("genes"), F.array_join(F.sort_array(F.collect_list("gene")), ",").alias("members"))


def location(df: DataFrame, value: str, *by: str) -> DataFrame:
    """(by, median, mean, sd): exact median and sample standard deviation."""
    return df.groupBy(*by).agg(F.expr(f"percentile({value}, 0.5)").alias("median"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))

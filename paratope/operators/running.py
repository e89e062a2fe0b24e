"""Running sums over a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paratope.plans.shared import written


def running_sums(rows: DataFrame, keys: list[str | Column], value: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` (a whole number; null counts as 0) up to and with each row, in the order of ``keys`` (ascending
    columns, or sort expressions).

    ``keys`` should tell rows apart; equal ones come in any order. Rows are dealt to ranges of the keys, as many as the session
    has shuffle partitions, and written; the ranges' totals, a number each, are added up on the driver, and each range is summed by
    itself from the total of those before it. Ranges follow a sample of the keys, so it doesn't matter how alike they begin.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, base = "__range", "__base"
    ranged = written(rows.repartitionByRange(ranges, *keys).withColumn(part, F.spark_partition_id()), "ranges")
    own = F.coalesce(F.col(value), F.lit(0)).cast("long")
    before, bases = 0, []
    for r in sorted(ranged.groupBy(part).agg(F.sum(own).alias("s")).collect()):
        bases.append((r[part], before))
        before += r.s
    upto = F.sum(own).over(Window.partitionBy(part).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    offsets = spark.createDataFrame(bases, f"{part} int, {base} long")
    return ranged.withColumn(out, upto).join(F.broadcast(offsets), part).withColumn(out, F.col(out) + F.col(base)).select(*rows.columns, out)

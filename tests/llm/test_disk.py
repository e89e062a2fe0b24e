"""What the corpus operators leave on local disks."""

import time

from pyspark.sql import functions as F

from paratope.llm.common import Scratch


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    """Before, they stayed until the driver happened to collect its garbage, and stages of a query added up."""
    scratch = Scratch(spark, "disk")
    before = _shuffle_files(spark)
    counts = spark.range(200_000).groupBy((F.col("id") % 50_000).alias("k")).count()
    first = scratch.table(counts)
    second = scratch.table(first.withColumnRenamed("count", "n").join(counts, "k").groupBy("n").agg(F.sum("k").alias("k")))
    files = _shuffle_files(spark) - before
    for _ in range(25):
        if not files:
            break
        time.sleep(0.2)
        files &= _shuffle_files(spark)
    assert not files
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert second.count() == 1 and first.count() == counts.count() == 50_000

"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset and everything runs on this machine, a new one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set, so there is no folder that all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='paratope-')}"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to a table of its own and read again: its plan ends there, and a lost executor costs a reread. Its shuffle files go
    at once, and not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, **options)
    finally:
        spark.conf.unset(CLEANUP) if old is None else spark.conf.set(CLEANUP, old)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t._written)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

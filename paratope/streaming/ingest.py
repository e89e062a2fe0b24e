"""Structured Streaming over arriving reads and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_fasta(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """(read_id, seq) of FASTA files as they arrive in a folder."""
    raw = spark.readStream.option("maxFilesPerTrigger", max_files).option("lineSep", "\n>").text(folder)
    parts = F.split(F.regexp_replace("value", "^>", ""), "\r?\n", 2)
    return raw.where("trim(value) <> ''").select(F.split(parts[0], r"\s+")[0].alias("read_id"), F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s+", "").alias("seq"))


def write_deduplicated(stream: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append each batch's reads, one row an id within a batch, to a stage table; a replayed batch overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(["read_id"]).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger_once else writer).start()


def length_counts(stream: DataFrame) -> DataFrame:
    """Running histogram of read lengths; its state is one row a length."""
    return stream.groupBy(F.length("seq").alias("length")).agg(F.count("*").alias("cnt"))


def deduplicated(stream: DataFrame, within: str = "1 hour") -> DataFrame:
    """A stream with a column ``arrived``: one row an id among rows that arrive within the given time of each other, across batches;
    the state of older ids is dropped by the watermark."""
    return stream.withWatermark("arrived", within).dropDuplicatesWithinWatermark(["read_id"])


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(start, key, cnt) of tumbling windows; rows later than ``late`` no longer count."""
    counts = events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("cnt"))
    return counts.select(F.col("window.start").alias("start"), key, "cnt")

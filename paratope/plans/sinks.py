"""Sinks: FASTA, csv with a metadata line, clonotype files, summaries and stage tables."""

from __future__ import annotations

import csv
import gzip
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paratope.functions.sequences import fixed_width


def write_fasta(df: DataFrame, path: str, name: str = "read_id", seq: str = "seq", width: int = 70) -> None:
    """Records as text, one file a partition."""
    df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), fixed_width(F.col(seq), width)).alias("value")).write.mode("overwrite").text(path)


def write_stage(df: DataFrame, path: str, *partition: str) -> None:
    (df.write.mode("overwrite").partitionBy(*partition) if partition else df.write.mode("overwrite")).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def best_stage(spark: SparkSession, refined: str, plain: str, use_refined: bool) -> DataFrame:
    """The refined annotation, or the plain one's productive reads."""
    return read_stage(spark, refined) if use_refined else read_stage(spark, plain).where("v_j_frame = 'In-frame' AND stopcodon = 'No'")


def write_flags(rows: DataFrame, path: str, name: str = "queryid") -> None:
    """Ids by refinement flag, a folder a flag."""
    rows.select(F.explode("flags").alias("flag"), F.col(name).cast("string").alias("value")).write.mode("overwrite").partitionBy("flag").text(path)


def write_report(df: DataFrame, path: str, metadata: str = "", limit: int = 1_000_000) -> None:
    """A small result as one csv with a first line of metadata; gzip by the name. Rows come to the driver in batches."""
    if df.limit(limit + 1).count() > limit:
        raise ValueError("too many rows for a report; write a stage table")
    tmp = f"{path}.tmp"
    with (gzip.open(tmp, "wt", newline="") if path.endswith(".gz") else open(tmp, "w", newline="")) as f:
        if metadata:
            f.write(metadata + "\n")
        out = csv.writer(f)
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(["" if x is None else x for x in row])
    os.replace(tmp, path)


def write_clonotypes(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_summary(path: str, **values: object) -> None:
    """Insert or replace ``key:value`` lines."""
    old = dict(line.rstrip("\n").split(":", 1) for line in open(path)) if os.path.exists(path) else {}
    old |= {k: str(v) for k, v in values.items()}
    tmp = f"{path}.tmp"
    with open(tmp, "w") as f:
        f.writelines(f"{k}:{v}\n" for k, v in old.items())
    os.replace(tmp, path)


def write_params(path: str, options: dict) -> None:
    """A run's options, one a line, in order of their names."""
    with open(path, "w") as f:
        f.writelines(f"{k}: {'' if v is None else v}\n" for k, v in sorted(options.items()))


def motif_text(motif, number: int = 0, metrics: dict[str, float] | None = None, words: int = 0, seed: int = 0) -> str:
    """A motif as text: the matrix of log-odds by base, width, bits, other metrics, and words drawn from it with their scores."""
    rng = np.random.default_rng(seed)
    drawn = [f"{w}  {motif.score(w):.3f}" for w in (motif.emit(rng) for _ in range(words))]
    rows = [f"#{b} " + " ".join(f"{x:7.3f}" for x in motif.ratios[:, i]) for i, b in enumerate("ACGT")]
    return "\n".join([f"Log-odds matrix for Motif {number} {motif.consensus}", "# " + " ".join(f"{i:7d}" for i in range(len(motif))), *rows, f"Width: {len(motif)}", f"Bits: {motif.bits.sum():.4f}", *(f"{k}: {v:.6g}" for k, v in (metrics or {}).items()), *drawn]) + "\n"

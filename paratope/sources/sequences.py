"""FASTA and FASTQ files as DataFrames (read_id, seq, qual, sample), by Spark's own text reader."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def detect_format(name: str) -> str:
    """fastq if .fastq or .fq occurs in the name, fasta if .fasta or .fa does."""
    if ".fastq" in name or ".fq" in name:
        return "fastq"
    if ".fasta" in name or ".fa" in name:
        return "fasta"
    raise ValueError(f"{name}: neither a FASTA nor a FASTQ file")


def sample_name(name: str, paired: bool = False) -> str:
    """A sample's name from a file's: what precedes _R1/_R2 of paired files, else the first dot."""
    base = name.rsplit("/", 1)[-1]
    return re.split(r"_R[12]", base)[0] if paired and re.search(r"_R[12]", base) else base.split(".", 1)[0]


def read_fasta(spark: SparkSession, path: str, key: Column | None = None, sample: str = "") -> DataFrame:
    """Records of FASTA files, gzip included. A record is what lies between lines that begin with ``>``; its id is the header's
    first word, or ``key``, an expression over ``header``. Lines of a sequence are joined."""
    raw = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("r")).where("trim(r) <> ''")
    parts = raw.select(F.trim(F.split("r", "\r?\n", 2)[0]).alias("header"), F.coalesce(F.try_element_at(F.split("r", "\r?\n", 2), F.lit(2)), F.lit("")).alias("body"))
    return parts.select((key if key is not None else F.split("header", r"\s+")[0]).alias("read_id"), F.regexp_replace("body", r"\s+", "").alias("seq"), F.lit(None).cast("string").alias("qual"), F.lit(sample).alias("sample"), "header")


def read_fastq(spark: SparkSession, path: str, sample: str = "") -> DataFrame:
    """Records of FASTQ files: an ``@`` line, a sequence line, a ``+`` line and a quality line of the sequence's length.

    Spark cuts files at ``\\n@``, large plain ones in several splits, compressed ones as a whole. A quality line may begin with
    ``@`` as well: then the record comes in two pieces, a head of three lines and a tail of one. They meet in the task that reads
    both; where a split ends between them, the head is joined to the first piece of the file's next split. Those ends are found by
    a second look at the files, which gives two rows a split at most. Records with fewer than four lines are left out.
    """
    pieces = spark.read.text(path, lineSep="\n@").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    whole = pieces.mapInPandas(lambda frames: _records(frames, False), PIECES).select("text")
    ends = pieces.mapInPandas(lambda frames: _records(frames, True), PIECES)
    along = Window.partitionBy("file").orderBy("block", "head")  # a split begins with a tail and ends with a head
    cut = ends.withColumns({"before": F.lag("text").over(along), "was_head": F.lag("head").over(along)}).where("NOT head AND was_head").select(F.concat("before", F.lit("\n@"), "text").alias("text"))
    lines = F.split("text", "\r?\n")
    rows = whole.unionByName(cut).select(lines.alias("l"))
    header = F.trim(F.col("l")[0])
    return rows.select(F.split(header, r"\s+")[0].alias("read_id"), F.col("l")[1].alias("seq"), F.regexp_replace(F.col("l")[3], "\r$", "").alias("qual"), F.lit(sample).alias("sample"), header.alias("header"))


PIECES = "file string, block long, head boolean, text string"


def _records(frames: Iterator[pd.DataFrame], ends: bool) -> Iterator[pd.DataFrame]:
    """Whole records of the pieces of some splits or, with ``ends``, heads without a tail and tails without a head."""
    at, head = None, None
    for f in frames:
        out = []
        for text, file, block in zip(f["value"], f["file"], f["block"], strict=True):
            if (file, block) != at:
                if head is not None and ends:
                    out.append((*at, True, head))
                at, head, first = (file, block), None, True
            else:
                first = False
            text = text.removeprefix("@") if block == 0 and first else text
            lines = text.rstrip("\r\n").count("\n") + 1 if text.strip() else 0
            if head is not None and lines <= 1:
                if not ends:
                    out.append((file, block, False, f"{head}\n@{text}"))
                head = None
            elif text.count("\n") >= 3:
                head = None
                if not ends:
                    out.append((file, block, False, text))
            elif lines == 3:
                head = text
            elif lines == 1 and first and block > 0 and ends:
                out.append((file, block, False, text))
        yield pd.DataFrame(out, columns=["file", "block", "head", "text"])
    if head is not None and ends:
        yield pd.DataFrame([(*at, True, head)], columns=["file", "block", "head", "text"])


def read_sequences(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    name = sample_name(path) if sample is None else sample
    return read_fastq(spark, path, name) if detect_format(path) == "fastq" else read_fasta(spark, path, sample=name)


def to_fasta(reads: DataFrame) -> DataFrame:
    """Records without their qualities."""
    return reads.select("read_id", "seq")


def last_of_each(records: DataFrame) -> DataFrame:
    """(read_id, seq): of records that share an id the last one, in the order of the files."""
    return records.withColumn("__n", F.monotonically_increasing_id()).groupBy("read_id").agg(F.max_by("seq", "__n").alias("seq"))


def germline_groups(records: DataFrame) -> DataFrame:
    """(gene, seqs): germline sequences by the second field of their header."""
    return records.groupBy(F.split("header", r"\|")[1].alias("gene")).agg(F.sort_array(F.collect_list("seq")).alias("seqs"))


def quality_by_position(reads: DataFrame) -> DataFrame:
    """(position, mean, median, a, c, g, t): quality and base composition at each place of the reads."""
    rows = reads.select(F.posexplode(F.split("seq", "")).alias("position", "base"), "qual").where("base <> ''")
    q = F.ascii(F.expr("substring(qual, position + 1, 1)")) - 33
    share = lambda b: F.avg(F.when(F.upper("base") == b, 1.0).otherwise(0.0)).alias(b.lower())
    return rows.groupBy("position").agg(F.avg(q).alias("mean"), F.percentile_approx(q, 0.5).alias("median"), *map(share, "ACGT"))


def merge_pairs(first: DataFrame, second: DataFrame, overlap: int = 15, mismatch: float = 0.1) -> DataFrame:
    """(read_id, seq): pairs joined where the end of the first read and the start of the second one's reverse complement agree
    best, over at least ``overlap`` bases with at most a share ``mismatch`` of differences; other pairs are left out."""
    flip = str.maketrans("ACGTN", "TGCAN")

    @F.pandas_udf("string")
    def merge(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            if x is None or y is None:
                out.append(None)
                continue
            z, best = y.upper().translate(flip)[::-1], None
            p, q = np.frombuffer(x.upper().encode(), np.uint8), np.frombuffer(z.encode(), np.uint8)
            for n in range(min(len(p), len(q)), overlap - 1, -1):
                same = int((p[-n:] == q[:n]).sum())
                if n - same <= mismatch * n and (best is None or same > best[0]):
                    best = (same, n)
            out.append(x + z[best[1] :] if best else None)
        return pd.Series(out, dtype=object)

    met = first.select("read_id", F.col("seq").alias("a")).join(second.select("read_id", F.col("seq").alias("b")), "read_id")
    return met.select("read_id", merge("a", "b").alias("seq")).where("seq IS NOT NULL")

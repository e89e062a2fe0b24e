"""Row filters on annotated reads, and set operations on id lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Inclusive bounds; None leaves a side open.
DEFAULT_LIMITS = {"bitscore": (300, None), "alignlen": (250, None), "vstart": (1, 3), "vqstart": (1, None)}


def within(limits: dict = DEFAULT_LIMITS) -> Column:
    """True where every column lies within its bounds; a missing value doesn't."""
    tests = [t for c, (lo, hi) in limits.items() for t in ([F.col(c) >= lo] if lo is not None else []) + ([F.col(c) <= hi] if hi is not None else [])]
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.lit(True)), F.lit(False))


def accepted(annot: DataFrame, limits: dict = DEFAULT_LIMITS) -> DataFrame:
    return annot.where(within(limits))


def rejected(annot: DataFrame, limits: dict = DEFAULT_LIMITS) -> DataFrame:
    return annot.where(~within(limits)).select("queryid", "vgene", "vstart", "vqstart", "bitscore", "alignlen")


def productive(annot: DataFrame) -> DataFrame:
    return annot.where("v_j_frame = 'In-frame' AND stopcodon = 'No'")


def restrict(left: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is in ``ids``; duplicates of ``left`` stay."""
    return left.join(ids.select(key), key, "left_semi")


def exclude(left: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return left.join(ids.select(key), key, "left_anti")


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def one_only(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids in exactly one of two lists."""
    marks = a.select(key).distinct().withColumn("m", F.lit(1)).unionByName(b.select(key).distinct().withColumn("m", F.lit(2)))
    return marks.groupBy(key).agg(F.sum("m").alias("m")).where("m < 3").select(key)


def random_subset(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows chosen by a seeded hash of the key, the same ones on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def random_split(df: DataFrame, key: str, share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts by a seeded hash of the key; no shuffle."""
    first = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 20)) < int(share * (1 << 20))
    return df.where(first), df.where(~first)

"""Dimension tables from delimited files: genome features, chromosomes, categories, array maps, expression; and chromosome ranges."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fields(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    """(f): the trimmed fields of each line of a file without a header."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.transform(F.split("value", re.escape(separator), -1), lambda x: F.trim(x)).alias("f"))


def _at(i: int) -> Column:
    return F.nullif(F.get(F.col("f"), F.lit(i)), F.lit(""))


def _number(i: int, kind: str = "long") -> Column:
    return F.expr(f"try_cast(get(f, {i}) AS {kind})")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(type, orf, gene, aliases, chrom, start, end, description) of a feature table; rows without a place are kept with nulls."""
    return fields(spark, path).select(_at(1).alias("type"), _at(3).alias("orf"), _at(4).alias("gene"), F.split(_at(5), r"\|").alias("aliases"), _number(8, "int").alias("chrom"), _number(9).alias("start"), _number(10).alias("end"), _at(15).alias("description"))


def gene_names(features: DataFrame) -> DataFrame:
    """(gene, orf) of open reading frames."""
    return features.where("type LIKE 'ORF%' AND gene IS NOT NULL AND orf IS NOT NULL").select("gene", "orf").distinct()


def read_chromosomes(spark: SparkSession, path: str) -> DataFrame:
    return fields(spark, path).select(_number(0, "int").alias("chrom"), _number(2).alias("length")).where("chrom IS NOT NULL AND length IS NOT NULL")


def read_categories(spark: SparkSession, path: str, orf: int = 0, aspect: int = 3, category: int = 4, omit: tuple[str, ...] = ()) -> DataFrame:
    """(gene, category) of biological processes (aspect P), without categories that say nothing and negated rows."""
    rows = fields(spark, path).where(F.get("f", F.lit(aspect)) == "P").select(_at(orf).alias("gene"), _at(category).alias("category"))
    return rows.where("gene IS NOT NULL AND category IS NOT NULL AND NOT category LIKE 'NOT %'").where(~F.col("category").isin(*omit) if omit else F.lit(True)).distinct()


def read_array_map(spark: SparkSession, path: str) -> DataFrame:
    """(orf, probe, gene, function) of a comma-separated map with a header line."""
    rows = spark.read.csv(path, header=True)
    pick = lambda i, n: F.trim(F.col(f"`{rows.columns[i]}`")).alias(n)
    return rows.select(pick(0, "orf"), pick(2, "probe"), pick(8, "gene"), pick(9, "function"))


def read_probe_orfs(spark: SparkSession, path: str) -> DataFrame:
    """(probe, type, orf): lines of a probe, its kind and its reading frames, marked ``A|`` or ``B|``."""
    words = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where("trim(value) <> ''").select(F.get(words, F.lit(0)).alias("probe"), F.get(words, F.lit(1)).alias("type"), F.explode(F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(0)))).alias("o"))
    return rows.select("probe", "type", F.regexp_replace("o", r"[AB]\|", "").alias("orf"))


def read_spots(spark: SparkSession, path: str) -> DataFrame:
    """(probe, position): lines of a probe and its places on the array."""
    words = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where("trim(value) <> ''").select(F.get(words, F.lit(0)).alias("probe"), F.explode(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))).alias("position"))


def read_expression(spark: SparkSession, path: str, name: int = 0, value: int = 1) -> DataFrame:
    """(orf, level); a value ``#`` is missing."""
    return fields(spark, path).select(_at(name).alias("orf"), _number(value, "double").alias("level"))


def chromosome_range(chromosomes: DataFrame, where: str) -> DataFrame:
    """(chrom, start, end, seq) of ``chr4:454-465``, both ends included, counted from 1, from a table (chrom, seq)."""
    found = re.fullmatch(r"(?:chr)?(\w+):(\d+)-(\d+)", where)
    if not found:
        raise ValueError(f"{where}: not a range")
    name, start, end = found[1], int(found[2]), int(found[3])
    rows = chromosomes.where(F.regexp_replace(F.col("chrom").cast("string"), "^chr", "") == name)
    return rows.select("chrom", F.lit(start).alias("start"), F.lit(end).alias("end"), F.substring("seq", start, max(0, end - start + 1)).alias("seq"))


def chain_ranges(atoms: DataFrame) -> DataFrame:
    """(chain, first, last) residue numbers of a structure's chains."""
    return atoms.groupBy("chain").agg(F.min("number").alias("first"), F.max("number").alias("last"))

"""Primer specificity: the primer at either end of a read, how intact it is, and where indels lie."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.functions.align import primer_matcher
from paratope.functions.sequences import family, gene, reverse_complement
from paratope.operators.abundance import shares
from paratope.operators.refine import settled


def width(primers: list[tuple[str, str]]) -> int:
    return max(len(p) for _, p in primers)


def add_primers(rows: DataFrame, primers: list[tuple[str, str]], side: str, offset: int = 0) -> DataFrame:
    """Adds primer5/mismatch5/indel5 (or ...3): the best match in the read's first or last letters, as wide as the longest primer.
    Needs strand and seq. The id is ``nan`` where nothing matches."""
    seq = F.when(F.col("strand") == "reversed", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    n = width(primers)
    window = F.substring(seq, offset + 1, n) if side == "5" else F.when(F.length(seq) > n, F.substring(seq, -n, n)).otherwise(seq)
    match = primer_matcher([(n, p.upper()) for n, p in primers], extend5=side == "5")
    out = settled(rows.withColumn("__m", match(window)))
    return out.withColumns({f"primer{side}": F.col("__m.id"), f"mismatch{side}": F.col("__m.mismatch"), f"indel{side}": F.col("__m.indel")}).drop("__m")


def integrity(rows: DataFrame, side: str) -> DataFrame:
    """(class, cnt) of unknown, indelled, mismatched and intact primers; the second and third may overlap."""
    known, m, i = F.col(f"primer{side}") != "nan", F.col(f"mismatch{side}") > 0, F.col(f"indel{side}") > 0
    one = rows.agg(F.count_if(~known).alias("Unknown"), F.count_if(known & i).alias("Indelled"), F.count_if(known & m).alias("Mismatched"), F.count_if(known & ~m & ~i).alias("Intact"))
    return one.unpivot([], one.columns, "class", "cnt")


def indelled(rows: DataFrame, side: str) -> DataFrame:
    """(subset, primer, cnt, pct) of indelled primers among all, out-of-frame and productive reads."""
    subsets = F.array_compact(F.array(F.lit("all"), F.when(F.col("v_j_frame") == "Out-of-frame", "out-of-frame"), F.when((F.col("v_j_frame") == "In-frame") & (F.col("stopcodon") == "No"), "productive")))
    hit = rows.where((F.col(f"primer{side}") != "nan") & (F.col(f"indel{side}") > 0))
    return shares(hit.select(F.explode(subsets).alias("subset"), F.col(f"primer{side}").alias("primer")), "subset", "primer", within=["subset"])


def indel_positions(rows: DataFrame, side: str) -> DataFrame:
    """(primer, position, cnt) of first indels."""
    return rows.where((F.col(f"primer{side}") != "nan") & (F.col(f"indel{side}") > 0)).groupBy(F.col(f"primer{side}").alias("primer"), F.col(f"indel{side}").alias("position")).agg(F.count("*").alias("cnt"))


def indelled_genes(rows: DataFrame, side: str) -> DataFrame:
    """(primer, level, name, cnt) of the V genes and families of the reads whose primer has an indel, and of all of those (level
    ``all``), in one pass."""
    hit = rows.where((F.col(f"primer{side}") != "nan") & (F.col(f"indel{side}") > 0) & F.col("vgene").isNotNull())
    named = hit.select(F.col(f"primer{side}").alias("primer"), gene(F.col("vgene")).alias("gene"), family(F.col("vgene")).alias("family"))
    sets = named.groupingSets([["primer", "gene"], ["primer", "family"], ["primer"]], "primer", "gene", "family").agg(F.count("*").alias("cnt"))
    level = F.when(F.col("gene").isNotNull(), "gene").when(F.col("family").isNotNull(), "family").otherwise("all")
    return sets.select("primer", level.alias("level"), F.coalesce("gene", "family", F.lit("all")).alias("name"), "cnt")

"""Sequences upstream of the V gene (5'UTR and secretion signal): extraction and classes, as column expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.functions.sequences import family, gene, reverse_complement, translate_dna


def reach(rows: DataFrame, first: int) -> DataFrame:
    """(reach): one row with the last place that ``extract`` takes from any of these rows, 0 at least."""
    return rows.agg(F.greatest(F.lit(0), F.max(F.when(F.col("vstart") <= 3, F.col("vqstart") - first - F.col("vstart") + 1))).cast("int").alias("reach"))


def extract(rows: DataFrame, first: int, last: int) -> DataFrame:
    """(id, vgene, upstream): the stretch from ``last`` to ``first`` bases before the V gene, of reads whose alignment begins within
    its first three bases. Needs queryid, vgene, strand, vstart, vqstart and seq. A stretch that would end before base 2 is left out."""
    seq = F.when(F.col("strand") == "reversed", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    end = F.col("vqstart") - first - F.col("vstart") + 1
    start = F.greatest(F.lit(1), F.col("vqstart") - last - F.col("vstart") + 1)
    kept = rows.where(F.col("vstart") <= 3).withColumn("__end", end).withColumn("__start", start).where("__end > 1")
    return kept.select(F.concat_ws("|", "queryid", "vgene").alias("id"), "vgene", F.substring(seq, F.col("__start"), F.greatest(F.col("__end") - F.col("__start") + 1, F.lit(0))).alias("upstream"))


def classify(upstream: DataFrame, kind: str, lengths: tuple[int, int]) -> DataFrame:
    """Adds gene, family and class: valid, faulty (an X or a stop in the protein, or an N), no-atg or ignored (length out of
    bounds). ``kind`` is secsig, which is translated, or 5utr, whose sequences with an N are left out."""
    s = F.upper("upstream")
    ignored = ~F.length(s).between(*lengths)
    if kind == "secsig":
        protein = F.expr("substring(__protein, 2)")
        rows = upstream.withColumn("__protein", translate_dna(s))
        faulty = F.contains(s, F.lit("N")) | F.contains(protein, F.lit("X")) | F.contains(protein, F.lit("*"))
        cls = F.when(ignored, "ignored").when(faulty, "faulty").when(~F.startswith(s, F.lit("ATG")), "no-atg").otherwise("valid")
        rows = rows.withColumn("class", cls).drop("__protein")
    else:
        rows = upstream.where(~F.contains(s, F.lit("N"))).withColumn("class", F.when(ignored, "ignored").otherwise("valid"))
    return rows.withColumn("gene", gene(F.col("vgene"))).withColumn("family", family(F.col("vgene"), strip_d=False))


def counts(classified: DataFrame) -> DataFrame:
    """(level, name, class, cnt) by gene and family in one pass."""
    sets = classified.groupingSets([["gene", "class"], ["family", "class"]], "gene", "family", "class").agg(F.count("*").alias("cnt"))
    return sets.select(F.when(F.col("gene").isNotNull(), "gene").otherwise("family").alias("level"), F.coalesce("gene", "family").alias("name"), "class", "cnt")


def length_distribution(upstream: DataFrame) -> DataFrame:
    return upstream.groupBy(F.length("upstream").alias("length")).agg(F.count("*").alias("cnt"))


def motif_counts(classified: DataFrame) -> DataFrame:
    """(level, name, kind, pos, letter, cnt): letters at each place of the sequences of each variant, gene and family, in one pass.

    Kinds are dna (valid ones), protein (the same translated), faulty and untranslated (no start codon); those of unexpected length
    are left out. Sequences aren't padded, so a place counts those that reach it.
    """
    s = F.upper("upstream")
    texts = F.array(
        F.struct(F.when(F.col("class") == "valid", "dna").when(F.col("class") == "faulty", "faulty").when(F.col("class") == "no-atg", "untranslated").alias("kind"), s.alias("text")),
        F.struct(F.when(F.col("class") == "valid", "protein").alias("kind"), F.when(F.col("class") == "valid", F.col("protein")).alias("text")),
    )
    rows = classified.withColumn("protein", translate_dna(F.when(F.col("class") == "valid", s))).select("vgene", "gene", "family", F.inline(texts)).where("kind IS NOT NULL AND text <> ''")
    letters = rows.select("vgene", "gene", "family", "kind", F.posexplode(F.split("text", "")).alias("pos", "letter")).where("letter <> ''")
    # Variants are counted first; genes and families add them up.
    own = letters.groupBy("vgene", "gene", "family", "kind", "pos", "letter").agg(F.count("*").alias("n"))
    rest = ["kind", "pos", "letter"]
    sets = own.groupingSets([["vgene", *rest], ["gene", *rest], ["family", *rest]], "vgene", "gene", "family", *rest).agg(F.sum("n").alias("cnt"))
    level = F.when(F.col("vgene").isNotNull(), "variant").when(F.col("gene").isNotNull(), "gene").otherwise("family")
    return sets.select(level.alias("level"), F.coalesce("vgene", "gene", "family").alias("name"), *rest, "cnt")

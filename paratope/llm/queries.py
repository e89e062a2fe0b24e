"""The queries opN_<name> with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paratope.llm import binary, bpe, kdshards, langid, lattice, merge, negatives, njoin, packing, simhash, suffixes, suffixtree, units
from paratope.llm.common import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.lattice_groups(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"), min_words=50)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return njoin.jaccard_groups(table(spark, sf_dir, "documents"), k=5, num=75, den=100)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs, ~langid.held_out()))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op5_unit_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of repeated passages of 20 words and more."""
    return units.repeated_passages(table(spark, sf_dir, "documents"), units.LINE, run_words=20)


def op5_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that occurs twice or more, whatever stands around it."""
    return units.repeated_passages(table(spark, sf_dir, "documents"), units.LINE, run_words=1)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"), k=5)


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(table(spark, sf_dir, "documents"), suffixtree.held_out())


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, size=2048)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "tokens").root
    binary.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return binary.read_tokens(spark, folder)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(table(spark, sf_dir, "embeddings"))


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshards.balanced_shards(table(spark, sf_dir, "documents"), shards=16)


def op13_branch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merged_branches(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lattice": op1_lattice,
    "op2_suffix_array": op2_suffix_array,
    "op3_ngram_join": op3_ngram_join,
    "op4_language": op4_language,
    "op5_unit_hash": op5_unit_hash,
    "op5_repeated_lines": op5_repeated_lines,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_suffix_tree": op8_suffix_tree,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_kd_shards": op12_kd_shards,
    "op13_branch_merge": op13_branch_merge,
}

ORACLES: dict[str, str] = {"op5_unit_hash": units.ORACLE, "op5_repeated_lines": units.ORACLE.replace("run_words >= 20", "run_words >= 1"), "op11_hard_negatives": negatives.ORACLE, "op13_branch_merge": merge.oracle()}

"""What a session offers to SQL: the derived tables as views, and alignment and statistics as functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from paratope.functions.align import ALIGNED, best_alignment, best_identity
from paratope.functions.stats import hypergeometric_tail
from paratope.plans.derived import TABLES, table


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Temporary views of all derived tables."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return list(TABLES)


def register_functions(spark: SparkSession) -> list[str]:
    """``align_dna`` and ``align_protein`` (sequence, query), ``best_identity`` (a, b) and ``hypergeometric_tail`` for SQL."""

    def aligner(dna: bool):
        @F.pandas_udf(ALIGNED)
        def run(s: pd.Series, q: pd.Series) -> pd.DataFrame:
            found = [best_alignment(x, y, dna) if x and y else None for x, y in zip(s, q, strict=True)]
            return pd.DataFrame([f or (None, None, None) for f in found], columns=["start", "end", "gapped"])

        return run

    @F.pandas_udf("int")
    def identity(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([best_identity(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="int32")

    @F.pandas_udf("double")
    def tail(found: pd.Series, draws: pd.Series, marked: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series([hypergeometric_tail(*map(int, x)) for x in zip(found, draws, marked, total, strict=True)], dtype=float)

    made = {"align_dna": aligner(True), "align_protein": aligner(False), "best_identity": identity, "hypergeometric_tail": tail}
    for name, fn in made.items():
        spark.udf.register(name, fn)
    return list(made)

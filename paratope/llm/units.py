"""Substring dedup by unit hashing: lines or paragraphs are normalised and hashed, and of equal units only the first one stays."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paratope.llm.common import Scratch, join_hot, parted, release

WORD = re.compile(r"[^ \t-\r]+")
LINE = "\n"
PARAGRAPH = "\n\n"
UNITS = "doc_id long, text_hash long, unit int, place int, start int, end int, words int, digest binary"


def _digest(x: bytes) -> bytes:
    return hashlib.blake2b(x, digest_size=16).digest()


def units_of(docs: DataFrame, separator: str, min_words: int) -> DataFrame:
    """UNITS of each text that have ``min_words`` words: a unit's number from 0, its place among the units with words, its span in
    code points (separators lie outside), its words, and the digest of its normal form (A-Z in lower case, words joined by one
    space). ``text_hash`` keeps apart rows that share an id."""

    def run(batches):
        release()
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        names = ["doc_id", "text_hash", "unit", "place", "start", "end", "words", "digest"]
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                rows = []
                for doc, key, text in zip(*(b.column(i).slice(lo, 256).to_pylist() for i in range(3)), strict=True):
                    at = place = 0
                    for i, raw in enumerate(text.split(separator)):
                        words = raw.encode().lower().split()
                        if len(words) >= min_words:
                            rows.append((doc, key, i, place, at, at + len(raw), len(words), _digest(b" ".join(words))))
                        place += bool(words)
                        at += len(raw) + len(separator)
                cols = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], names=names)

    return docs.where("text <> ''").select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, UNITS)


def _repeated(docs: DataFrame, separator: str, min_words: int, scratch: Scratch) -> DataFrame:
    """All units that occur twice or more, with the first of each kind in ascending (doc_id, unit) and whether this is another."""
    units = scratch.table(units_of(docs, separator, min_words))
    first = units.groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash", "unit")).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = scratch.table(first)
    met = join_hot(units, first.select("digest", "f"), "digest", first.select("digest", "n"), units.count(), "inner")
    same = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_hash") == F.col("f.text_hash")) & (F.col("unit") == F.col("f.unit"))
    return met.select("doc_id", "text_hash", "unit", "place", "start", "end", "words", F.col("f.doc_id").alias("first_doc_id"), F.col("f.unit").alias("first_unit"), (~same).alias("removed"))


def repeated_units(docs: DataFrame, separator: str = LINE, min_words: int = 5) -> DataFrame:
    """The units that another one of the same normal form precedes, in ascending (doc_id, unit).

    Takes (doc_id, text); returns (doc_id, text_hash, unit, start, end, words, first_doc_id, first_unit), a row for each unit to
    remove; start and end are code points of the original text. Units of fewer than ``min_words`` words are left alone, as are
    null and empty texts. A null id ranks first. Rows that repeat both id and text rank the same and keep or lose the same units.
    Other columns are ignored; an empty table gives no rows.
    """
    return _repeated(docs, separator, min_words, Scratch(docs.sparkSession, "units")).where("removed").drop("place", "removed")


def repeated_passages(docs: DataFrame, separator: str = LINE, run_words: int = 20) -> DataFrame:
    """The units of repeated passages: of runs of units, one after another, that all occur elsewhere too and have ``run_words`` words
    together.

    Takes (doc_id, text); returns (doc_id, unit, start, end, words, run_words, first_doc_id, first_unit, removed), a row for each
    unit of such a run, whether it is the first of its kind (which stays) or another (which goes). Units without words neither
    count nor part a run. start and end are code points of the original text. Null and empty texts have none. A null id ranks
    first; rows that repeat both id and text give their units once. Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    found = scratch.table(_repeated(docs, separator, 1, scratch).distinct())
    text = Window.partitionBy("doc_id", "text_hash")
    runs = found.withColumn("run", F.col("place") - F.row_number().over(text.orderBy("place")))
    runs = runs.withColumn("run_words", F.sum("words").over(Window.partitionBy("doc_id", "text_hash", "run")))
    return runs.where(F.col("run_words") >= run_words).select("doc_id", "unit", "start", "end", "words", "run_words", "first_doc_id", "first_unit", "removed")


def without_units(docs: DataFrame, removed: DataFrame, separator: str = LINE) -> DataFrame:
    """``docs`` with the spans of ``removed`` and the separators after them cut out of text; all other columns are kept, and
    ``kept_at`` lists where each kept stretch began in the original text (it takes the place of a column of that name). Where ``separator``
    is empty, spans count words, and what parts the last one from the next word goes as well."""
    width = len(separator)
    scratch = Scratch(docs.sparkSession, "cuts")
    cuts = scratch.table(removed.select("doc_id", "text_hash", "start", "end").distinct().groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts")))
    names = [n for n in docs.columns if n.lower() != "kept_at"]
    docs = docs.select(*names)
    own = "__cuts"
    while own in {n.lower() for n in names}:
        own += "_"

    @F.arrow_udf("text string, kept_at array<int>")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        release()
        texts, kept = [], []
        for t, own in zip(text.to_pylist(), spans.to_pylist(), strict=True):
            at, parts, starts = 0, [], []
            if own and not separator:
                words = [m.start() for m in WORD.finditer(t)] + [len(t)]
                own = [{k: words[v] for k, v in s.items()} for s in own]
            for s in own or ():
                if s["start"] > at:
                    parts.append(t[at : s["start"]])
                    starts.append(at)
                at = max(at, min(len(t), s["end"] + width))
            if t is not None and at < len(t):
                parts.append(t[at:])
                starts.append(at)
            texts.append(None if t is None else "".join(parts))
            kept.append(starts)
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(kept, pa.list_(pa.int32()))], names=["text", "kept_at"])

    # Texts without a cut, most of them, don't go through the join or through Python.
    maybe, rest = parted(docs, F.xxhash64("text"), cuts.select("text_hash"))
    maybe = scratch.table(maybe)  # else a task has two Python workers at once, and all of them stay
    c = cuts.select(F.col("doc_id").alias(f"{own}1"), F.col("text_hash").alias(f"{own}2"), F.col("cuts").alias(f"{own}3"))
    met = maybe.join(c, F.col("doc_id").eqNullSafe(F.col(f"{own}1")) & (F.xxhash64("text") == F.col(f"{own}2")), "left")
    met = met.select(*names, cut("text", f"{own}3").alias(own))
    whole = F.when(F.length("text") > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return met.select(*(F.col(f"{own}.text") if n == "text" else F.col(n) for n in names), F.col(f"{own}.kept_at")).unionByName(rest.withColumn("kept_at", whole))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS unit
  FROM documents WHERE text IS NOT NULL
), placed AS (
  SELECT doc_id, unit, length(raw) AS size,
         sum(length(raw) + 1) OVER (PARTITION BY doc_id ORDER BY unit) - length(raw) - 1 AS "at",
         trim(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM lines
), counted AS (
  SELECT *, length(norm) - length(replace(norm, ' ', '')) + 1 AS n, row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS place FROM placed WHERE norm <> ''
), ranked AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY norm) AS copies, first_value(doc_id) OVER w AS fd, first_value(unit) OVER w AS fu
  FROM counted WINDOW w AS (PARTITION BY norm ORDER BY doc_id, unit)
), runs AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM ranked WHERE copies > 1
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id, run) AS run_words FROM runs
)
SELECT doc_id, CAST(unit AS INT) AS unit, CAST("at" AS INT) AS "start", CAST("at" + size AS INT) AS "end", CAST(n AS INT) AS words,
       CAST(run_words AS BIGINT) AS run_words, fd AS first_doc_id, CAST(fu AS INT) AS first_unit, k > 1 AS removed
FROM summed WHERE run_words >= 20
"""

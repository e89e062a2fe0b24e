"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius by permuted block tables (Manku et al. 2007).

Everything here is DataFrame expressions. A term's 64-bit hash votes on 64 bits with the weight of its occurrences; the votes for
bits k and k + 32 are counted in the two halves of one long, so 32 sums serve 64 bits.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paratope.llm.common import Scratch, shuffle_partitions

LANES = 0x0000000100000001
SPACES = "\t\n\x0b\x0c\r"


def terms(text: Column, k: int) -> Column:
    """64-bit hashes of the runs of k words of a text (of all its words if fewer); none if it has no word."""
    words = F.array_remove(F.split(F.translate(F.lower(text), SPACES, " " * len(SPACES)), " ", -1), "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    # The array is bound as a lambda's variable, so it is made once and not once a run.
    runs = F.transform(
        F.array(hashed),
        lambda a: F.when(F.size(a) >= k, F.transform(F.sequence(F.lit(0), F.greatest(F.size(a) - k, F.lit(0))), lambda i: F.xxhash64(*(a[i + j] for j in range(k)))))
        .when(F.size(a) > 0, F.array(F.xxhash64(a)))
        .otherwise(F.array().cast("array<bigint>")),
    )
    return runs[0]


def votes(term: Column) -> list[Column]:
    return [F.sum(F.shiftright(term, bit).bitwiseAND(F.lit(LANES))).alias(f"v{bit}") for bit in range(32)]


def decided() -> Column:
    """The fingerprint from the sums of ``votes`` and the number of terms ``n``: a bit is 1 if more than half of the votes are."""
    out = F.lit(0).cast("bigint")
    for bit in range(32):
        for shift in (0, 32):
            ones = F.shiftrightunsigned(F.col(f"v{bit}"), shift).bitwiseAND(F.lit(0xFFFFFFFF))
            out = out.bitwiseOR(F.when(2 * ones > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), bit + shift)).otherwise(F.lit(0).cast("bigint")))
    return out


def fingerprints(texts: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """(keys, fingerprint) of a DataFrame (keys, text); the fingerprint is a long, 0 for a null, empty or wordless text.

    The terms of a text are counted where the text is, so only its sums are shuffled. A text may hold up to 2**31 terms.
    """
    rows = texts.select(*keys, F.explode_outer(terms(F.coalesce("text", F.lit("")), k)).alias("term"))
    return rows.groupBy(*keys).agg(F.count("term").alias("n"), *votes(F.col("term"))).select(*keys, F.when(F.col("n") > 0, decided()).otherwise(F.lit(0).cast("bigint")).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def within_radius(prints: DataFrame, radius: int = 3, spare: int = 3) -> DataFrame:
    """Pairs (a, b, distance), a < b, of different fingerprints at most ``radius`` bits apart, from a column ``fingerprint``.

    64 bits are cut into radius + spare blocks; any two such fingerprints agree on at least ``spare`` of them, so each choice of
    ``spare`` blocks is a table keyed by those. A pair is taken from the table of the first blocks it agrees on, and so once.
    Equal fingerprints are one row here, which keeps copies out of the tables. Null fingerprints have no pair.
    """
    blocks = radius + spare
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    tables = list(combinations(range(blocks), spare))
    table_masks = [signed(sum(masks[i] for i in t)) for t in tables]
    own = prints.where("fingerprint is not null").select("fingerprint").distinct()
    keyed = own.select("fingerprint", F.explode(F.array(*(F.struct(F.lit(i).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(table_masks)))).alias("x")).select("fingerprint", "x.t", "x.key")
    met = keyed.withColumnRenamed("fingerprint", "a").join(keyed.withColumnRenamed("fingerprint", "b"), ["t", "key"]).where("a < b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*(F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(table_masks)))
    return met.withColumn("distance", F.bit_count(differ)).where((F.col("distance") <= radius) & (first == F.col("t"))).select("a", "b", "distance")


def successors(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, doc_id, text, next_row, next_text): each document with the next one in ascending doc_id, the first after the last.

    Ties of doc_id go by a hash of the text; null ids come first. Rows are dealt to ranges of ids; the first row of each range is
    also sent to the range before it, so a window within each range sees every successor.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    n = docs.count()
    ranges = max(1, min(4096, max(4 * shuffle_partitions(spark), n // 1000)))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges)).first()[0] or []
    edges = F.array(*(F.lit(int(c)).cast("bigint") for c in sorted(set(cuts)))) if cuts else F.array().cast("array<bigint>")
    ranged = rows.withColumn("range", F.size(F.filter(edges, lambda c: c <= F.col("doc_id"))))
    fronts = [r.asDict() for r in ranged.groupBy("range").agg(F.min(F.struct("doc_id", "tie", "row")).alias("f")).select("range", "f.doc_id", "f.tie", "f.row").orderBy("range").collect()]
    sent = [(f["row"], fronts[i - 1]["range"]) for i, f in enumerate(fronts)]
    also = spark.createDataFrame(sent, "row long, before int")  # a row a range
    both = ranged.join(F.broadcast(also), "row", "left")
    guest = F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))
    host = F.struct(F.col("range"), F.lit(False).alias("guest"))
    dealt = both.withColumn("to", F.explode(F.when(F.col("before").isNull(), F.array(host)).otherwise(F.array(host, guest)))).select("row", "doc_id", "text", "tie", F.col("to.range").alias("range"), F.col("to.guest").alias("guest"))
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "tie", "row")
    out = dealt.select("row", "doc_id", "text", "guest", F.lead("row").over(order).alias("next_row"), F.lead("text").over(order).alias("next_text"))
    return out.where("not guest").drop("guest")


def edited_fingerprints(docs: DataFrame, k: int = 5) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is that of the next document's front.

    Takes (doc_id, text); returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row
    for each input row. A null text is the empty text, with fingerprint 0. Rows that repeat an id follow one another in the order of a
    hash of their text. A table of one row is its own next document; an empty table gives no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = successors(docs, scratch).select("row", "next_row", "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text")), F.struct(F.lit(1).alias("which"), edited.alias("text")))).alias("x"))
    rows = rows.select("row", "next_row", "doc_id", "n_chars", "x.which", F.when(F.col("x.which") == 1, F.sha2("x.text", 256)).alias("sha"), F.col("x.text").alias("text"))
    prints = scratch.table(fingerprints(rows, ["row", "next_row", "doc_id", "n_chars", "which", "sha"], k))
    own = prints.where("which = 0").select("row", "next_row", "doc_id", "n_chars", "fingerprint")
    other = prints.where("which = 1").select("row", F.col("sha").alias("edited_sha256"), F.col("fingerprint").alias("e"))
    nxt = own.select(F.col("row").alias("next_row"), F.col("fingerprint").alias("f"))
    out = own.join(other, "row").join(nxt, "next_row")
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return out.select("doc_id", "n_chars", "edited_sha256", text("fingerprint").alias("fingerprint"), text("e").alias("edited_fingerprint"), likeness(F.col("fingerprint"), F.col("e")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("f")).alias("near_next"))

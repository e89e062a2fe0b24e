"""Restriction-site analysis: hits of sites in reads, statistics by enzyme and overlaps between enzymes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paratope.functions.sequences import IUPAC, iupac_regex, reverse_complement
from paratope.operators.productivity import REGIONS
from paratope.plans.shared import written


def sites_table(spark, sites: list[tuple[str, str]]) -> DataFrame:
    """(enzyme, iupac, regex); of enzymes named twice the last one counts."""
    return spark.createDataFrame([(e, s, iupac_regex(s)) for e, s in dict(sites).items()], "enzyme string, iupac string, regex string")


def hit_count(seq: Column, regex: str) -> Column:
    """Non-overlapping hits; the reverse complement is tried only if the sequence has none."""
    forward = F.regexp_count(F.upper(seq), F.lit(regex))
    return F.when(forward > 0, forward).otherwise(F.regexp_count(reverse_complement(F.upper(seq)), F.lit(regex)))


def hits(reads: DataFrame, sites: list[tuple[str, str]], *keep: str) -> DataFrame:
    """(read_id, enzyme, iupac, n_hits) of reads that an enzyme cuts. The few sites are literals, so no join is needed."""
    each = [F.struct(F.lit(e).alias("enzyme"), F.lit(s).alias("iupac"), hit_count(F.col("seq"), iupac_regex(s)).alias("n_hits")) for e, s in dict(sites).items()]
    return reads.select("read_id", *keep, F.inline(F.array(*each))).where("n_hits > 0")


def statistics(reads: DataFrame, sites: list[tuple[str, str]]) -> DataFrame:
    """Hits and cut molecules of each enzyme with their shares, and the rows ``Cut by any`` and ``Total``; shares are of 100."""
    named = list(dict(sites).items())
    # One search of the texts: a row for each read_id leaves it, and all figures are sums of these rows.
    counts = reads.select("read_id", F.inline(F.array(F.struct(*(hit_count(F.col("seq"), iupac_regex(s)).alias(f"h{i}") for i, (_, s) in enumerate(named))))))
    own = [x for i in range(len(named)) for x in (F.sum(F.when(F.col(f"h{i}") > 0, F.col(f"h{i}"))).alias(f"h{i}"), F.count_if(F.col(f"h{i}") > 0).alias(f"c{i}"))]
    ids = counts.groupBy("read_id").agg(F.count("*").alias("n"), *own)
    some = F.greatest(F.lit(0), *(F.col(f"c{i}") for i in range(len(named)))) > 0
    sums = [x for i in range(len(named)) for x in (F.sum(f"h{i}").alias(f"h{i}"), F.sum(f"c{i}").alias(f"c{i}"))]
    one = written(ids.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("molecules"), F.count_if(some & F.col("read_id").isNotNull()).alias("cut"), *sums), "hits")
    total = one.select("molecules")
    each = [F.struct(F.lit(e).alias("enzyme"), F.lit(s).alias("iupac"), F.col(f"h{i}").alias("hits"), F.col(f"c{i}").alias("cut")) for i, (e, s) in enumerate(named)]
    per = one.select(F.inline(F.array(*each))).where("cut > 0")
    every = per.agg(F.sum("hits").alias("all_hits"))
    rows = per.crossJoin(F.broadcast(every)).crossJoin(F.broadcast(total))
    share = lambda a, b: F.round(F.try_divide(100.0 * F.col(a), F.col(b)), 6)
    listed = rows.select("enzyme", "iupac", "hits", share("hits", "all_hits").alias("pct_hits"), F.col("cut").alias("molecules"), share("cut", "molecules").alias("pct_molecules"))
    cut = one.select("cut", "molecules")
    any_ = cut.select(F.lit("Cut by any").alias("enzyme"), F.lit("").alias("iupac"), F.lit(None).cast("long").alias("hits"), F.lit(None).cast("double").alias("pct_hits"), F.col("cut").alias("molecules"), share("cut", "molecules").alias("pct_molecules"))
    all_ = total.crossJoin(every).select(F.lit("Total").alias("enzyme"), F.lit("").alias("iupac"), F.coalesce("all_hits", F.lit(0)).alias("hits"), F.lit(100.0).alias("pct_hits"), "molecules", F.lit(100.0).alias("pct_molecules"))
    return listed.unionByName(any_).unionByName(all_)


def jaccard(found: DataFrame, enzymes: list[str]) -> DataFrame:
    """(a, b, jaccard) of the sets of reads each two enzymes cut; 1 for two empty sets.

    Each read gives its own few pairs of enzymes, so the pairs follow the hits and no set is gathered.
    """
    masks = found.groupBy("read_id").agg(F.sort_array(F.collect_set("enzyme")).alias("e"))
    pairs = masks.select(F.explode("e").alias("a"), "e").select("a", F.explode("e").alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))
    spark = found.sparkSession
    grid = spark.createDataFrame([(x, y) for x in enzymes for y in enzymes], "a string, b string")
    size = pairs.where("a = b")
    full = grid.join(pairs, ["a", "b"], "left").join(size.select("a", F.col("n").alias("na")), "a", "left").join(size.select("b", F.col("n").alias("nb")), "b", "left")
    n, na, nb = (F.coalesce(c, F.lit(0)) for c in ("n", "na", "nb"))
    return full.select("a", "b", F.round(F.coalesce(F.try_divide(n.cast("double"), na + nb - n), F.lit(1.0)), 9).alias("jaccard"))


def venn(found: DataFrame, enzymes: list[str]) -> DataFrame:
    """(mask, cnt): reads by the set of enzymes that cut them, as bits in the given order."""
    bit = sum((F.when(F.col("enzyme") == e, 1 << i).otherwise(0) for i, e in enumerate(enzymes)), F.lit(0))
    return found.where(F.col("enzyme").isin(enzymes)).groupBy("read_id").agg(F.bit_or(bit).alias("mask")).groupBy("mask").agg(F.count("*").alias("cnt"))


def hit_positions(seq: Column, regex: str) -> Column:
    """0-based starts of non-overlapping hits: the text is split at hits once, and lengths are added up."""
    both = F.struct(F.split(F.upper(seq), regex, -1).alias("gap"), F.regexp_extract_all(F.upper(seq), F.lit(f"({regex})"), 1).alias("hit"))

    def starts(x: Column) -> Column:
        pairs = F.arrays_zip(x["hit"].alias("hit"), F.slice(x["gap"], F.lit(1), F.size(x["hit"])).alias("gap"))
        zero = F.struct(F.array().cast("array<int>").alias("p"), F.lit(0).alias("at"))
        return F.aggregate(pairs, zero, lambda t, y: F.struct(F.array_append(t["p"], t["at"] + F.length(y["gap"])).alias("p"), (t["at"] + F.length(y["gap"]) + F.length(y["hit"])).alias("at")))["p"]

    return F.transform(F.array(both), starts)[0]


def region_of(position: Column) -> Column:
    """The first region whose 1-based inclusive bounds hold a 1-based position."""
    out = F.lit(None).cast("string")
    for r in reversed(REGIONS):
        out = F.when(position.between(F.col(f"{r}_start"), F.col(f"{r}_end")), F.lit(r)).otherwise(out)
    return out


def region_hits(rows: DataFrame, sites: list[tuple[str, str]]) -> DataFrame:
    """(enzyme, region, reads): reads with a hit that begins in the region, each once. Positions are those of the strand that was
    searched; hits on the reverse complement are mapped back."""
    found = site_starts(list(dict(sites).items()))(F.upper("seq"), reverse_complement(F.upper("seq")))
    return hit_regions(rows.withColumn("found", found)).distinct().groupBy("enzyme", "region").agg(F.count("*").alias("reads"))


def last_place(rows: DataFrame) -> DataFrame:
    """(last): one row with the last place of any region of these rows."""
    return rows.agg(F.greatest(F.lit(0), *(F.max(f"{r}_end") for r in REGIONS)).alias("last"))


def site_places(reads: DataFrame, sites: list[tuple[str, str]], last: DataFrame) -> DataFrame:
    """(read_id, found): for each enzyme its hits in a read, as ``site_starts`` has them, that begin at the place of ``last`` or before."""
    found = site_starts(list(dict(sites).items()))(F.upper("seq"), reverse_complement(F.upper("seq")))
    near = F.transform("found", lambda x: F.struct(x["enzyme"].alias("enzyme"), F.filter(x["at"], lambda p: p < F.col("last")).alias("at")))
    return reads.select("read_id", found.alias("found")).crossJoin(F.broadcast(last)).select("read_id", near.alias("found"))


def hit_regions(rows: DataFrame) -> DataFrame:
    """(read_id, enzyme, region): the regions of a row where a hit of ``found`` begins, each once a row."""
    long = rows.select("read_id", *(f"{r}_{x}" for r in REGIONS for x in ("start", "end")), F.inline("found"))
    each = long.where(F.size("at") > 0).select("read_id", "enzyme", F.explode(F.array_distinct(F.transform("at", lambda p: region_of(p + 1)))).alias("region"))
    return each.where("region IS NOT NULL")


def site_starts(sites: list[tuple[str, str]]):
    """An Arrow UDF of a text and its reverse complement: for each enzyme its name and the 0-based starts of its hits, without those
    that begin inside an earlier one; hits on the reverse complement, in places of the text, only where the text itself has none.
    A batch is searched at once: a letter's places are compared with the bases that each place of the site allows."""
    kind = pa.list_(pa.struct([("enzyme", pa.string()), ("at", pa.list_(pa.int32()))]))

    @F.arrow_udf("array<struct<enzyme:string,at:array<int>>>")
    def run(text: pa.Array, other: pa.Array) -> pa.Array:
        texts = [[x.encode("ascii", "replace") if x else b"" for x in c.to_pylist()] for c in (text, other)]
        rows: list[list[dict]] = [[] for _ in texts[0]]
        for name, site in sites:
            forward, back = (_starts(t, site) for t in texts)
            for row, size, f, b in zip(rows, map(len, texts[0]), forward, back, strict=True):
                row.append({"enzyme": name, "at": f if f else [size - p - len(site) for p in b]})
        return pa.array(rows, kind)

    return run


def _starts(texts: list[bytes], site: str) -> list[list[int]]:
    whole = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    n = len(whole) - len(site) + 1
    fits = np.ones(max(0, n), dtype=bool)
    for j, c in enumerate(site.upper()):
        allowed = np.zeros(256, dtype=bool)
        allowed[list((c if c == "U" else IUPAC.get(c, c)).encode())] = True
        if c == "N":
            allowed[:] = True
            allowed[10] = False  # the line feed between texts
        fits &= allowed[whole[j : j + n]]
    at = np.flatnonzero(fits)
    taken = np.ones(len(at), dtype=bool)
    taken[1:] = np.diff(at) >= len(site)
    front = np.flatnonzero(taken)
    free = taken.copy()
    while len(front):  # within stretches of overlapping hits, from each to the first one past its end
        front = np.searchsorted(at, at[front] + len(site))
        front = front[front < len(at)]
        front = front[~free[front]]
        taken[front] = True
    at = at[taken]
    cut = np.searchsorted(at, first)
    return [(at[a:b] - f).tolist() for a, b, f in zip(cut[:-1], cut[1:], first[:-1], strict=True)]

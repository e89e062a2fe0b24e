"""Every registered query of the library and, where SQL can express it, the same in DuckDB's SQL.

Queries run over whole tables, derived from the driver's as ``plans.derived`` says. Percentages are rounded to six digits.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paratope.functions import sequences as S
from paratope.functions import stats, words
from paratope.operators import abundance, classify, cluster, distances, diversity, em, filters, hts, intervals, motif_table, motifs, primer, productivity, refine, restriction, search, similar, trees, upstream
from paratope.plans.derived import oracle
from paratope.plans.derived import table as derived
from paratope.plans.shared import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = oracle(sql)
        return fn

    return add


def annot(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, "clone_annot")


SITES = [("E1", "GRTC"), ("E2", "CCWGG"), ("E3", "AAGCTT"), ("E4", "NNN")]
PRIMERS = [("P1", "GGTACGTTACGA"), ("P2", "ACGTAGCTTACG"), ("P3", "TTACGGATNNAT")]
ACCEPT = "bitscore >= 300 AND alignlen >= 250 AND vstart BETWEEN 1 AND 3 AND vqstart >= 1"
GENE = "split_part({0}, '*', 1)"
FAMILY = "rtrim(split_part(split_part(split_part({0}, '*', 1), '-', 1), '/', 1), 'D')"
V_GENE, V_FAMILY = GENE.format("vgene"), FAMILY.format("vgene")
REGIONS = productivity.REGIONS
RC = "reverse(translate({0}, 'ACGTRYKMSWBDHVNacgtrykmswbdhvn', 'TGCAYRMKSWVHDBNtgcayrmkswvhdbn'))"


def share(name: str, source: str, key: str) -> str:
    return f"SELECT {key} AS {name}, count(*) AS cnt, round(1e2 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM {source} GROUP BY 1"


# ---------------------------------------------------------------- abundance
@query("a1_v_family_abundance", share("family", f"clone_annot WHERE {ACCEPT}", V_FAMILY))
def _(spark, d):
    rows = filters.accepted(annot(spark, d)).where("vgene IS NOT NULL")
    return abundance.shares(rows, S.family(F.col("vgene")).alias("family"))


def _levels_sql(c: str) -> str:
    one = lambda level, e: f"SELECT '{level}' AS level, {e} AS name FROM f"
    return f"""WITH f AS (SELECT {c} FROM clone_annot WHERE {ACCEPT} AND {c} IS NOT NULL),
    n AS ({one("variant", c)} UNION ALL {one("gene", GENE.format(c))} UNION ALL {one("family", FAMILY.format(c))})
    SELECT level, name, count(*) AS cnt, round(1e2 * count(*) / sum(count(*)) OVER (PARTITION BY level), 6) AS pct FROM n GROUP BY 1, 2"""


for _c in ("vgene", "dgene", "jgene"):
    query(f"a1_{_c}_levels", _levels_sql(_c))(lambda spark, d, c=_c: abundance.by_level(filters.accepted(annot(spark, d)), c))


@query("a2_roll_up", f"SELECT {V_FAMILY} AS name, count(*) AS cnt FROM clone_annot WHERE vgene IS NOT NULL GROUP BY 1")
def _(spark, d):
    counts = annot(spark, d).where("vgene IS NOT NULL").groupBy("vgene").agg(F.count("*").alias("cnt"))
    return abundance.roll_up(counts, S.family(F.col("vgene")))


@query("a3_sequences_by_gene", f"SELECT {GENE.format('germline')} AS gene, count(*) AS cnt, sum(length(fr1)) AS bases FROM clone_seqs GROUP BY 1")
def _(spark, d):
    return derived(spark, d, "clone_seqs").groupBy(S.gene(F.col("germline")).alias("gene")).agg(F.count("*").alias("cnt"), F.sum(F.length("fr1")).alias("bases"))


@query("a3_sequence_lists", f"SELECT {GENE.format('germline')} AS gene, fr1, count(*) AS copies FROM clone_seqs GROUP BY 1, 2")
def _(spark, d):
    """The lists as (gene, sequence, copies), so that no gene's list must fit in a task."""
    return derived(spark, d, "clone_seqs").groupBy(S.gene(F.col("germline")).alias("gene"), "fr1").agg(F.count("*").alias("copies"))


@query("a4_vj_association", f"SELECT {V_FAMILY} AS v, {GENE.format('jgene')} AS j, count(*) AS value FROM clone_annot WHERE {ACCEPT} AND length(vgene) >= 5 AND length(jgene) >= 5 GROUP BY 1, 2")
def _(spark, d):
    return abundance.vj_association(filters.accepted(annot(spark, d)))


LENGTHS_SQL = "SELECT {g} AS gene, '{r}' AS region, {r}_end - {r}_start + 1 AS len FROM clone_annot WHERE v_j_frame = 'In-frame'"
FR_SQL = " UNION ALL ".join(LENGTHS_SQL.format(r=r, g=GENE.format(g)) for r, g in (("fr1", "vgene"), ("fr2", "vgene"), ("fr3", "vgene"), ("fr4", "jgene")))
FR_COUNTS = f"SELECT gene, region, len, count(*) AS cnt FROM ({FR_SQL}) x WHERE gene IS NOT NULL AND len IS NOT NULL GROUP BY 1, 2, 3"
CONSENSUS_SQL = f"SELECT gene, region, len FROM (SELECT *, row_number() OVER (PARTITION BY gene, region ORDER BY cnt DESC, len) AS rn FROM ({FR_COUNTS}) y) z WHERE rn = 1"


@query("a5_framework_lengths", FR_COUNTS)
def _(spark, d):
    return productivity.framework_lengths(annot(spark, d))


@query("a6_consensus_lengths", CONSENSUS_SQL)
def _(spark, d):
    return productivity.consensus(productivity.framework_lengths(annot(spark, d)))


def _fit(r: str, g: str) -> str:
    return f"coalesce(a.{r}_end - a.{r}_start + 1 = (SELECT max(len) FROM c WHERE c.region = '{r}' AND c.gene = {GENE.format('a.' + g)}), a.{r}_end IS NULL OR a.{r}_start IS NULL)"


@query("a6_filtered", f"WITH c AS ({CONSENSUS_SQL}) SELECT CASE WHEN a.v_j_frame = 'In-frame' AND {' AND '.join(_fit(r, g) for r, g in (('fr1', 'vgene'), ('fr2', 'vgene'), ('fr3', 'vgene'), ('fr4', 'jgene')))} THEN 'No' ELSE 'Yes' END AS filtered, count(*) AS cnt FROM clone_annot a GROUP BY 1")
def _(spark, d):
    return productivity.mark_filtered(annot(spark, d)).groupBy("filtered").agg(F.count("*").alias("cnt"))


SPECTRA = " UNION ALL ".join(f"SELECT '{n}' AS region, CAST(floor(({e} - {s} + 1) / 3) AS INT) AS len FROM clone_annot WHERE {ACCEPT}" for n, s, e in [*((r, f"{r}_start", f"{r}_end") for r in REGIONS), ("v", "fr1_start", "fr4_end")])


@query("a7_spectratypes", f"SELECT region, len, count(*) AS cnt FROM ({SPECTRA}) x WHERE len IS NOT NULL GROUP BY 1, 2")
def _(spark, d):
    return diversity.spectratypes(filters.accepted(annot(spark, d)))


WHOLE = f"CASE WHEN least({', '.join(f'length({r})' for r in REGIONS)}) > 0 THEN {' || '.join(REGIONS)} END"
REGION_ROWS = " UNION ALL ".join(f"SELECT germline, '{n}' AS region, {e} AS aa FROM clone_seqs" for n, e in [*((r, r) for r in REGIONS), ("v", WHOLE)])
CLONES = f"SELECT region, aa, count(*) AS cnt FROM ({REGION_ROWS}) x WHERE aa IS NOT NULL AND aa <> '' GROUP BY 1, 2"


@query("a8_clonotypes", CLONES)
def _(spark, d):
    return diversity.clonotypes(derived(spark, d, "clone_seqs"))


@query("a9_clonotypes_by_gene", f"SELECT {GENE.format('germline')} AS gene, region, aa, count(*) AS cnt FROM ({REGION_ROWS}) x WHERE aa IS NOT NULL AND aa <> '' GROUP BY GROUPING SETS ((1, 2, 3), (2, 3))")
def _(spark, d):
    return diversity.clonotypes_by_gene(derived(spark, d, "clone_seqs"))


@query(
    "a10_productivity",
    """WITH t AS (SELECT count(*) AS n, count(*) FILTER (v_j_frame = 'In-frame' AND stopcodon <> 'Yes') AS a, count(*) FILTER (v_j_frame = 'In-frame' AND stopcodon = 'Yes') AS b,
    count(*) FILTER (v_j_frame = 'Out-of-frame' AND stopcodon <> 'Yes') AS c, count(*) FILTER (v_j_frame = 'Out-of-frame' AND stopcodon = 'Yes') AS d FROM clone_annot),
    r AS (SELECT 'Productive' AS productivity, '-' AS reason, a AS cnt, n FROM t UNION ALL SELECT 'Unproductive', 'Stopcodon', b, n FROM t UNION ALL SELECT 'Unproductive', 'Out-of-Frame', c, n FROM t UNION ALL SELECT 'Unproductive', 'Both', d, n FROM t)
    SELECT productivity, reason, cnt, round(1e2 * cnt / n, 6) AS pct FROM r""",
)
def _(spark, d):
    return productivity.classes(annot(spark, d))


def _distribution_sql(columns: list[str], where: str = "TRUE") -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS metric, coalesce(CAST({c} AS VARCHAR), 'NaN') AS value FROM clone_annot WHERE {where}" for c in columns)
    return f"SELECT metric, value, count(*) AS cnt, round(1e2 * count(*) / sum(count(*)) OVER (PARTITION BY metric), 6) AS pct FROM ({rows}) x GROUP BY 1, 2"


@query("a11_gaps_mismatches", _distribution_sql(["vgaps", "vmismatches", "jgene"]))
def _(spark, d):
    return productivity.distributions(annot(spark, d), ["vgaps", "vmismatches", "jgene"])


GENE_COLUMNS = [f"{g}{x}" for g in "vdj" for x in ("gaps", "mismatches")]
REGION_COLUMNS = [f"{r}_{x}" for r in ("cdr1", "cdr2", "cdr3g", "fr1", "fr2", "fr3g") for x in ("gaps", "mismatches")]


@query("a11_gene_counters", _distribution_sql(GENE_COLUMNS))
def _(spark, d):
    return productivity.distributions(annot(spark, d), GENE_COLUMNS)


@query("a11_region_counters", _distribution_sql(REGION_COLUMNS))
def _(spark, d):
    return productivity.distributions(annot(spark, d), REGION_COLUMNS)


@query("a12_frames", _distribution_sql(["v_j_frame"]))
def _(spark, d):
    return productivity.distributions(annot(spark, d), ["v_j_frame"])


@query("a12_out_of_frame", _distribution_sql(["vgaps", "vmismatches"], "v_j_frame <> 'In-frame'"))
def _(spark, d):
    return productivity.distributions(annot(spark, d).where("v_j_frame <> 'In-frame'"), ["vgaps", "vmismatches"])


@query("a12_in_frame_stop_family", share("family", "clone_annot WHERE v_j_frame = 'In-frame' AND stopcodon = 'Yes'", V_FAMILY))
def _(spark, d):
    return abundance.shares(annot(spark, d).where("v_j_frame = 'In-frame' AND stopcodon = 'Yes'"), S.family(F.col("vgene")).alias("family"))


@query("a13_productive_family", share("family", "clone_annot WHERE v_j_frame = 'In-frame' AND stopcodon = 'No'", V_FAMILY))
def _(spark, d):
    return abundance.shares(filters.productive(annot(spark, d)), S.family(F.col("vgene")).alias("family"))


@query("a14_stops_by_region", " UNION ALL ".join(f"SELECT '{r}' AS region, count(*) FILTER (contains({r}, '*')) AS cnt FROM clone_seqs" for r in REGIONS))
def _(spark, d):
    return productivity.stops_by_region(derived(spark, d, "clone_seqs"))


FRAME_STOPS = "SELECT '{f}' AS frame, '{r}' AS region, count(*) FILTER (contains({r}, '*')) AS cnt FROM clone_seqs WHERE queryid IN (SELECT CAST(split_part(queryid, '-', 1) AS BIGINT) FROM clone_annot WHERE v_j_frame = '{f}')"


@query("a14_stops_by_frame", " UNION ALL ".join(FRAME_STOPS.format(f=f, r=r) for f in ("In-frame", "Out-of-frame") for r in REGIONS))
def _(spark, d):
    rows = annot(spark, d).select(F.split("queryid", "-")[0].cast("long").alias("queryid"), "v_j_frame")
    return productivity.stops_by_frame(rows, derived(spark, d, "clone_seqs"))


@query("a15_region_diversity", f"SELECT cdr3, count(*) AS cnt, {', '.join(f'count(DISTINCT {r}) AS n_{r}' for r in REGIONS if r != 'cdr3')} FROM clone_seqs WHERE length(cdr3) > 0 GROUP BY 1")
def _(spark, d):
    return diversity.region_diversity(derived(spark, d, "clone_seqs"))


@query(
    "a16_lengths_without_outliers",
    """WITH h AS (SELECT length(seq) AS value, count(*) AS cnt FROM reads GROUP BY 1), s AS (SELECT sum(cnt * value::DOUBLE) / sum(cnt) AS m, sqrt(greatest(sum(cnt * value::DOUBLE * value) / sum(cnt) - power(sum(cnt * value::DOUBLE) / sum(cnt), 2), 0)) AS sd FROM h)
    SELECT value, cnt FROM h, s WHERE abs(value - m) <= 4 * sd""",
)
def _(spark, d):
    return abundance.histogram(derived(spark, d, "reads"), F.length("seq"), outliers=False)


@query("a17_lengths_by_family", f"SELECT {V_FAMILY} AS family, alignlen, count(*) AS cnt FROM clone_annot GROUP BY 1, 2")
def _(spark, d):
    return annot(spark, d).groupBy(S.family(F.col("vgene")).alias("family"), "alignlen").agg(F.count("*").alias("cnt"))


@query("a18_distribution", share("chain_frame", "clone_annot", "concat(chain, '/', v_j_frame)"))
def _(spark, d):
    return abundance.shares(annot(spark, d), F.concat("chain", F.lit("/"), "v_j_frame").alias("chain_frame"))


@query(
    "a19_heatmap",
    """WITH e AS (SELECT min(alignlen)::DOUBLE AS x0, max(alignlen)::DOUBLE AS x1, min(identity) AS y0, max(identity) AS y1 FROM clone_annot),
    b AS (SELECT CAST(coalesce(least(floor((alignlen - x0) / nullif(x1 - x0, 0) * 10), 9), 0) AS INT) AS bx, CAST(coalesce(least(floor((identity - y0) / nullif(y1 - y0, 0) * 10), 9), 0) AS INT) AS "by" FROM clone_annot, e)
    SELECT bx, "by", count(*) AS cnt, round(1e2 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM b GROUP BY 1, 2""",
)
def _(spark, d):
    return abundance.heatmap(annot(spark, d), "alignlen", "identity")


CDR3 = "SELECT cdr3 AS aa, count(*) AS cnt FROM clone_seqs WHERE length(cdr3) > 0 AND cdr3 <> 'None' GROUP BY 1"


def _cdr3(spark, d):
    """Clonotypes by their whole CDR3."""
    return diversity.clonotypes(derived(spark, d, "clone_seqs").select(*REGIONS)).where("region = 'cdr3'").select("aa", "cnt")


DUPLICATION = """WITH s AS ({0}), f AS (SELECT region, cnt AS f, count(*) AS k FROM s GROUP BY 1, 2), t AS (SELECT region, sum(f * k) AS total FROM f GROUP BY 1),
    x AS (SELECT 10 + i * (10000 - 10) / 99.0::DOUBLE AS times FROM range(100) r(i))
    SELECT region, round(times, 6) AS times, round(n / total, 9) AS share FROM (SELECT region, f::DOUBLE AS times, k::DOUBLE AS n FROM f WHERE f < 10 UNION ALL SELECT region, times, sum(CASE WHEN f >= times THEN f * k ELSE 0 END)::DOUBLE FROM f, x GROUP BY 1, 2) y JOIN t USING (region)"""


@query("a20_duplication", DUPLICATION.format(f"SELECT 'cdr3' AS region, * FROM ({CDR3}) c"))
def _(spark, d):
    return diversity.duplication(_cdr3(spark, d).withColumn("region", F.lit("cdr3")))


COMPOSITION = "SELECT CAST(i AS INT) AS position, substring(cdr3, i::INT + 1, 1) AS aa, count(*) AS weight FROM clone_seqs, range(30) r(i) WHERE i < length(cdr3) GROUP BY 1, 2"


def _composition(spark, d):
    return diversity.composition(diversity.clonotypes(derived(spark, d, "clone_seqs")).where("region = 'cdr3'"))


@query("a21_composition", COMPOSITION)
def _(spark, d):
    return _composition(spark, d)


@query("a22_logo", f"WITH c AS ({COMPOSITION}), t AS (SELECT position, sum(weight) AS total FROM c GROUP BY 1) SELECT position, aa, round(weight / total, 9) AS fraction FROM c JOIN t USING (position) WHERE total >= 0.01 * (SELECT max(total) FROM t)")
def _(spark, d):
    return diversity.logo_fractions(_composition(spark, d))


# ---------------------------------------------------------------- restriction sites
def _hits_sql() -> str:
    one = lambda e, s: f"SELECT read_id, '{e}' AS enzyme, '{s}' AS iupac, CASE WHEN len(regexp_extract_all(upper(seq), '{S.iupac_regex(s)}')) > 0 THEN len(regexp_extract_all(upper(seq), '{S.iupac_regex(s)}')) ELSE len(regexp_extract_all({RC.format('upper(seq)')}, '{S.iupac_regex(s)}')) END AS n_hits FROM reads"
    return f"SELECT * FROM ({' UNION ALL '.join(one(e, s) for e, s in SITES)}) x WHERE n_hits > 0"


@query("c8_site_hits", _hits_sql())
def _(spark, d):
    return restriction.hits(derived(spark, d, "reads"), SITES)


@query(
    "a24_rsa_statistics",
    f"""WITH h AS ({_hits_sql()}), p AS (SELECT enzyme, iupac, CAST(sum(n_hits) AS BIGINT) AS hits, count(*) AS cut FROM h GROUP BY 1, 2), e AS (SELECT CAST(sum(hits) AS BIGINT) AS a FROM p), t AS (SELECT count(*) AS m FROM reads)
    SELECT enzyme, iupac, hits, round(1e2 * hits / a, 6) AS pct_hits, cut AS molecules, round(1e2 * cut / m, 6) AS pct_molecules FROM p, e, t
    UNION ALL SELECT 'Cut by any', '', NULL, NULL, count(DISTINCT read_id), round(1e2 * count(DISTINCT read_id) / max(m), 6) FROM h, t
    UNION ALL SELECT 'Total', '', a, 1e2, m, 1e2 FROM e, t""",
)
def _(spark, d):
    return restriction.statistics(derived(spark, d, "reads"), SITES)


@query(
    "a25_rsa_jaccard",
    f"""WITH h AS ({_hits_sql()}), n AS (SELECT * FROM (VALUES ('E1'), ('E2'), ('E3'), ('E4')) v(e)), s AS (SELECT enzyme, count(*) AS c FROM h GROUP BY 1),
    i AS (SELECT x.enzyme AS a, y.enzyme AS b, count(*) AS c FROM h x JOIN h y USING (read_id) GROUP BY 1, 2)
    SELECT p.e AS a, q.e AS b, round(coalesce(coalesce(i.c, 0)::DOUBLE / nullif(coalesce(sa.c, 0) + coalesce(sb.c, 0) - coalesce(i.c, 0), 0), 1), 9) AS jaccard
    FROM n p CROSS JOIN n q LEFT JOIN i ON i.a = p.e AND i.b = q.e LEFT JOIN s sa ON sa.enzyme = p.e LEFT JOIN s sb ON sb.enzyme = q.e""",
)
def _(spark, d):
    return restriction.jaccard(restriction.hits(derived(spark, d, "reads"), SITES), [e for e, _ in SITES])


@query("a28_venn", f"WITH h AS ({_hits_sql()}) SELECT CAST(mask AS INT) AS mask, count(*) AS cnt FROM (SELECT read_id, sum(CASE enzyme WHEN 'E1' THEN 1 WHEN 'E2' THEN 2 ELSE 4 END) AS mask FROM h WHERE enzyme IN ('E1', 'E2', 'E3') GROUP BY 1) x GROUP BY 1")
def _(spark, d):
    return restriction.venn(restriction.hits(derived(spark, d, "reads"), SITES), ["E1", "E2", "E3"])


def _annotation_of(reads: DataFrame, spark, d) -> DataFrame:
    """One annotation row of each text with its read's number by a synthetic id, as the fixtures say; no reads travel with it."""
    n = reads.agg(F.count("*").alias("n"))
    rows = annot(spark, d).dropDuplicates(["queryid"]).withColumn("__k", F.split("queryid", "-")[0].cast("long"))
    return rows.crossJoin(F.broadcast(n)).withColumn("read_id", F.col("__k") % F.col("n")).drop("__k", "n")


def _reads_with_annotation(spark, d):
    """One read of each text joined to each annotation row."""
    reads = derived(spark, d, "reads")
    return _annotation_of(reads, spark, d).join(reads.drop("sample"), "read_id")


def _ends_with_annotation(spark, d, ends: DataFrame) -> DataFrame:
    """Annotation rows joined to what was made of one end of their read, in the direction of their strand."""
    rows = _annotation_of(derived(spark, d, "reads"), spark, d).withColumn("reversed", F.coalesce(F.col("strand") == "reversed", F.lit(False)))
    return rows.join(ends, ["read_id", "reversed"]).drop("reversed")


# ---------------------------------------------------------------- upstream, primers, refinement
ONE_EACH = "SELECT DISTINCT ON (queryid) * FROM clone_annot"
WITH_READS = f"SELECT a.*, r.seq FROM ({ONE_EACH}) a JOIN reads r ON r.read_id = CAST(split_part(a.queryid, '-', 1) AS BIGINT) % (SELECT count(*) FROM reads)"
UPSTREAM = f"""SELECT vgene, concat_ws('|', queryid, vgene) AS id, substring(CASE WHEN strand = 'reversed' THEN {RC.format("seq")} ELSE seq END, st, greatest(en - st + 1, 0)) AS upstream
FROM (SELECT *, vqstart - 1 - vstart + 1 AS en, greatest(1, vqstart - 20 - vstart + 1) AS st FROM ({WITH_READS}) w WHERE vstart <= 3) x WHERE en > 1"""


def _upstream(spark, d):
    """Only the letters that an annotation can reach go through the join."""
    reads = derived(spark, d, "reads").crossJoin(F.broadcast(upstream.reach(annot(spark, d), 1)))
    return upstream.extract(_ends_with_annotation(spark, d, S.read_ends(reads.select("read_id", "seq", "reach"), F.col("reach"))), 1, 20)


@query("c10_upstream", UPSTREAM)
def _(spark, d):
    return _upstream(spark, d).select("vgene", "id", "upstream")


@query("c10_upstream_lengths", f"WITH u AS ({UPSTREAM}) SELECT length(upstream) AS length, count(*) AS cnt FROM u GROUP BY 1")
def _(spark, d):
    return upstream.length_distribution(_upstream(spark, d))


def _positions_sql(text: str, site: str) -> str:
    parts = f"string_split_regex({text}, '{S.iupac_regex(site)}')"
    return f"list_transform(range(0, len({parts}) - 1), lambda i: i * {len(site)} + list_sum(list_transform({parts}[1:i + 1], lambda x: length(x))))"


def _region_hits_sql() -> str:
    one = lambda e, s: f"SELECT read_id, '{e}' AS enzyme, unnest(CASE WHEN len(f) > 0 THEN f ELSE list_transform(b, lambda p: n - p - {len(s)}) END) AS p FROM (SELECT read_id, length(s) AS n, {_positions_sql('s', s)} AS f, {_positions_sql(RC.format('s'), s)} AS b FROM u) x"
    region = "CASE " + " ".join(f"WHEN p + 1 BETWEEN {r}_start AND {r}_end THEN '{r}'" for r in REGIONS) + " END"
    return f"""WITH u AS (SELECT read_id, upper(seq) AS s FROM reads), h AS ({" UNION ALL ".join(one(e, s) for e, s in SITES[:3])}), a AS (SELECT *, CAST(split_part(queryid, '-', 1) AS BIGINT) % (SELECT count(*) FROM reads) AS k FROM ({ONE_EACH}) o)
    SELECT enzyme, region, count(*) AS reads FROM (SELECT DISTINCT queryid, enzyme, {region} AS region FROM a JOIN h ON h.read_id = a.k) j WHERE region IS NOT NULL GROUP BY 1, 2"""


@query("c9_region_hits", _region_hits_sql())
def _(spark, d):
    """Each read is searched once; the places of its hits go to its annotations, which are of different ids."""
    reads = derived(spark, d, "reads")
    rows = _annotation_of(reads, spark, d).join(restriction.site_places(reads, SITES[:3], restriction.last_place(annot(spark, d))), "read_id")
    return restriction.hit_regions(rows).groupBy("enzyme", "region").agg(F.count("*").alias("reads"))


PLAIN_FAMILY = "split_part(split_part(split_part(vgene, '*', 1), '-', 1), '/', 1)"
CLASSES = f"""WITH u AS ({UPSTREAM}), k AS (SELECT vgene, CASE WHEN length(upstream) NOT BETWEEN 10 AND 20 THEN 'ignored'
    WHEN contains(upper(upstream), 'N') OR regexp_matches(substring(upper(upstream), 4), '^(...)*(TAA|TAG|TGA)') THEN 'faulty' WHEN NOT starts_with(upper(upstream), 'ATG') THEN 'no-atg' ELSE 'valid' END AS class FROM u)
    SELECT 'gene' AS level, {V_GENE} AS name, class, count(*) AS cnt FROM k GROUP BY 2, 3 UNION ALL SELECT 'family', {PLAIN_FAMILY}, class, count(*) FROM k GROUP BY 2, 3"""


@query("a29_upstream_classes", CLASSES)
def _(spark, d):
    return upstream.counts(upstream.classify(_upstream(spark, d), "secsig", (10, 20)))


def _with_primers(spark, d, side):
    """Each read is matched once a strand; its primer goes to its annotations."""
    ends = S.read_ends(derived(spark, d, "reads"), F.lit(primer.width(PRIMERS)), tail=side == "3")
    named = primer.add_primers(ends.withColumn("strand", F.when(F.col("reversed"), "reversed").otherwise("forward")), PRIMERS, side)
    return _ends_with_annotation(spark, d, named.select("read_id", "reversed", *(f"{c}{side}" for c in ("primer", "mismatch", "indel"))))


@query("a26_primer_integrity")
def _(spark, d):
    return primer.integrity(_with_primers(spark, d, "5"), "5")


@query("a26_primer_integrity_3")
def _(spark, d):
    return primer.integrity(_with_primers(spark, d, "3"), "3")


@query("a27_indelled_primers")
def _(spark, d):
    return primer.indelled(_with_primers(spark, d, "5"), "5")


@query("a27_indel_positions")
def _(spark, d):
    return primer.indel_positions(_with_primers(spark, d, "5"), "5")


@query("u7_refinement_flags")
def _(spark, d):
    """No flag hangs on the columns that are left out."""
    reads = derived(spark, d, "reads")
    bounds = [f"{r}_{x}" for r in REGIONS[:5] for x in ("start", "end")]
    rows = _annotation_of(reads, spark, d).select("read_id", "vgene", "chain", "strand", "v_j_frame", "stopcodon", "vstart", "vqstart", "jqend", *bounds, *(f"{r}_gaps" for r in (*refine.GAPPED, "cdr3g")))
    return refine.flag_counts(refine.refine_reads(rows, reads.drop("sample")))


# ---------------------------------------------------------------- filters, set operations, order
@query("f1_accepted", f"SELECT queryid, vgene, bitscore FROM clone_annot WHERE {ACCEPT}")
def _(spark, d):
    return filters.accepted(annot(spark, d)).select("queryid", "vgene", "bitscore")


@query("f2_rejected", f"SELECT queryid, vgene, vstart, vqstart, bitscore, alignlen FROM clone_annot WHERE NOT coalesce({ACCEPT}, FALSE)")
def _(spark, d):
    return filters.rejected(annot(spark, d))


@query("f5_restrict", f"SELECT s.* FROM clone_seqs s WHERE queryid IN (SELECT CAST(split_part(queryid, '-', 1) AS BIGINT) FROM clone_annot WHERE {ACCEPT})")
def _(spark, d):
    ids = filters.accepted(annot(spark, d)).select(F.split("queryid", "-")[0].cast("long").alias("queryid"))
    return filters.restrict(derived(spark, d, "clone_seqs"), ids, "queryid")


@query("f6_slices", f"SELECT queryid, substring(seq, greatest(vqstart - vstart, 0) + 1, greatest(coalesce(fr4_end, length(seq)) - greatest(vqstart - vstart, 0), 0)) AS slice FROM ({WITH_READS}) w WHERE vstart <= 2")
def _(spark, d):
    rows = _reads_with_annotation(spark, d).where("vstart <= 2")
    return rows.select("queryid", S.slice_read(F.col("seq"), F.col("vqstart"), F.col("vstart"), F.col("fr4_end")).alias("slice"))


@query("f7_iupac_match", "SELECT read_id, translate(reverse(seq), 'ACGT', 'RYRY') = translate(seq, 'ACGT', 'RYRY') AS mirrored, NOT contains(seq, 'T') AS without_t FROM reads")
def _(spark, d):
    """Whole sequences against the purines and pyrimidines of the sequence read backwards, and against codes that all lack T."""
    seq = F.col("seq")
    mirrored, no_t = F.translate(F.reverse(seq), "ACGT", "RYRY"), F.regexp_replace(seq, ".", "V")
    return derived(spark, d, "reads").select("read_id", S.matches_codes(seq, mirrored, S.IUPAC).alias("mirrored"), S.matches_codes(seq, no_t, S.IUPAC).alias("without_t"))


@query("f8_amino_match", "SELECT queryid, translate(fr1, 'DNEQIL', 'BBZZJJ') = translate(reverse(fr1), 'DNEQIL', 'BBZZJJ') AS mirrored, NOT contains(cdr1, '*') AS residues FROM clone_seqs WHERE fr1 <> '' AND cdr1 <> ''")
def _(spark, d):
    """FR1 against the ambiguous codes of itself read backwards, and CDR1 against X, which stands for any residue."""
    rows = derived(spark, d, "clone_seqs").where("fr1 <> '' AND cdr1 <> ''")
    codes = F.translate(F.reverse("fr1"), "DNEQIL", "BBZZJJ")
    return rows.select("queryid", S.matches_codes(F.col("fr1"), codes, S.AMINO_CODES).alias("mirrored"), S.matches_codes(F.col("cdr1"), F.regexp_replace("cdr1", ".", "X"), S.AMINO_CODES).alias("residues"))


@query("f14_plain_sequences", "WITH r AS (SELECT read_id, replace(seq, 'GGTACC', 'GGNACC') AS seq FROM reads) SELECT read_id, seq FROM r WHERE NOT regexp_matches(upper(seq), '[NRYKMSWBDHV]')")
def _(spark, d):
    """Of the reads with an N in place of a letter of each GGTACC, those that stay plain."""
    rows = derived(spark, d, "reads").select("read_id", F.replace("seq", F.lit("GGTACC"), F.lit("GGNACC")).alias("seq"))
    return S.plain_sequences(rows).select("read_id", "seq")


@query("f14_strip_n", "SELECT read_id, regexp_replace(concat('NN', seq, 'N'), '^N+|N+$', '', 'g') AS seq FROM reads")
def _(spark, d):
    return derived(spark, d, "reads").select("read_id", S.strip_n(F.concat(F.lit("NN"), F.col("seq"), F.lit("N"))).alias("seq"))


@query("e1_union", "SELECT doc_id FROM labels WHERE quality = 1 UNION SELECT doc_id FROM labels WHERE toxic = 1")
def _(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return filters.either(labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1").select("doc_id"))


@query("e1_intersection", "SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return filters.restrict(labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1"), "doc_id")


@query("e1_xor", "WITH a AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1), b AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) (SELECT doc_id FROM a EXCEPT SELECT doc_id FROM b) UNION (SELECT doc_id FROM b EXCEPT SELECT doc_id FROM a)")
def _(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return filters.one_only(labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1").select("doc_id"), "doc_id")


@query("e1_and_not", "SELECT doc_id FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)")
def _(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return filters.exclude(labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1"), "doc_id")


@query("e4_random_split")
def _(spark, d):
    a, b = filters.random_split(derived(spark, d, "reads"), "read_id", 0.5, seed=7)
    return a.agg(F.count("*").alias("first")).crossJoin(b.agg(F.count("*").alias("second")))


@query("o1_top_clonotypes", f"WITH s AS ({CDR3}) SELECT aa, cnt, round(1e2 * cnt / (SELECT sum(cnt) FROM s), 6) AS pct FROM s ORDER BY cnt DESC, aa LIMIT 50")
def _(spark, d):
    return abundance.top(_cdr3(spark, d), 50, "aa")


@query("o1_rare_clonotypes", f"WITH s AS ({CDR3}) SELECT aa, cnt, round(1e2 * cnt / (SELECT sum(cnt) FROM s), 6) AS pct FROM s ORDER BY cnt, aa LIMIT 50")
def _(spark, d):
    return abundance.top(_cdr3(spark, d), 50, "aa", rare=True)


@query("w3_cumulative", f"WITH s AS ({CDR3}) SELECT aa, cnt, CAST(sum(cnt) OVER (ORDER BY aa ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM s")
def _(spark, d):
    return diversity.cumulative(_cdr3(spark, d), "aa")


@query("w5_average_ranks", "SELECT experiment, probe, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0::DOUBLE AS rank FROM hts")
def _(spark, d):
    return stats.average_ranks(derived(spark, d, "hts"), "value")


# ---------------------------------------------------------------- sequence functions
@query("c1_reverse_complement", f"SELECT read_id, {RC.format('seq')} AS rc FROM reads")
def _(spark, d):
    return derived(spark, d, "reads").select("read_id", S.reverse_complement(F.col("seq")).alias("rc"))


CODE_SQL = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in S.CODONS.items()) + "}"


@query("c3_translate", f"SELECT read_id, CASE WHEN length(seq) >= 3 THEN list_aggregate(list_transform(range(1, length(seq) - 1, 3), lambda i: coalesce(element_at({CODE_SQL}, substring(seq, i, 3))[1], 'X')), 'string_agg', '') ELSE '' END AS protein FROM reads")
def _(spark, d):
    return derived(spark, d, "reads").select("read_id", S.translate_dna(F.col("seq")).alias("protein"))


@query("c4_protein_fragment", f"SELECT a.queryid, substring({' || '.join('s.' + r for r in REGIONS)}, CAST(greatest(floor((fr1_start - vstart - 1) / 3), 0) AS INT) + 1, greatest(CAST(floor((fr1_end - vstart) / 3) AS INT) - CAST(greatest(floor((fr1_start - vstart - 1) / 3), 0) AS INT), 0)) AS frag FROM clone_annot a JOIN clone_seqs s ON s.queryid = CAST(split_part(a.queryid, '-', 1) AS BIGINT)")
def _(spark, d):
    protein = derived(spark, d, "clone_seqs").select(F.col("queryid").alias("id"), F.concat(*REGIONS).alias("protein"))
    rows = annot(spark, d).withColumn("id", F.split("queryid", "-")[0].cast("long")).join(protein, "id")
    return rows.select("queryid", S.protein_fragment(F.col("protein"), F.col("fr1_start"), F.col("fr1_end"), F.col("vstart")).alias("frag"))


@query("c7_hit_positions", """WITH p AS (SELECT read_id, string_split_regex(upper(seq), 'G[AG]TC') AS parts FROM reads), i AS (SELECT read_id, parts, unnest(range(0, len(parts) - 1)) AS i FROM p)
    SELECT read_id, CAST(i * 4 + list_sum(list_transform(parts[1:i + 1], lambda x: length(x))) AS INT) AS place FROM i""")
def _(spark, d):
    return derived(spark, d, "reads").select("read_id", F.explode(restriction.hit_positions(F.col("seq"), S.iupac_regex("GRTC"))).alias("place"))


@query("c14_identical_places", "SELECT read_id, CAST(coalesce(list_sum(list_transform(list_zip(string_split(seq, ''), list_reverse(string_split(seq, ''))), lambda x: CASE WHEN x[1] = x[2] THEN 1 ELSE 0 END)), 0) AS INT) AS same FROM reads WHERE seq <> ''")
def _(spark, d):
    return derived(spark, d, "reads").where("seq <> ''").select("read_id", S.identical_places(F.col("seq"), F.reverse("seq")).alias("same"))


@query("c16_fixed_width", "SELECT read_id, rtrim(regexp_replace(seq, '(.{70})', '\\1' || chr(10), 'g'), chr(10)) AS text FROM reads")
def _(spark, d):
    return derived(spark, d, "reads").select("read_id", S.fixed_width(F.col("seq")).alias("text"))


# ---------------------------------------------------------------- diversity estimators
RAREFACTION = """WITH s AS ({0}), f AS (SELECT region, cnt AS f, count(*) AS k FROM s GROUP BY 1, 2), t AS (SELECT region, CAST(sum(cnt) AS BIGINT) AS n FROM s GROUP BY 1),
    x AS (SELECT region, m FROM (SELECT unnest({1}) AS m) y, t WHERE m < n UNION SELECT region, n FROM t),
    l AS (SELECT region, m, k, CASE WHEN m > n - f THEN 0 ELSE exp(lgamma(n - f + 1) - lgamma(n - f - m + 1) - lgamma(n + 1) + lgamma(n - m + 1)) END AS missed FROM f JOIN t USING (region) JOIN x USING (region))
    SELECT region, CAST(m AS BIGINT) AS n, round(sum(k * (1 - missed)), 6) AS expected FROM l GROUP BY 1, 2"""


@query("d1_rarefaction", f"SELECT n, expected FROM ({RAREFACTION.format(f"SELECT 'cdr3' AS region, * FROM ({CDR3}) c", diversity.ticks(10**15))}) r")
def _(spark, d):
    counts = _cdr3(spark, d)
    return diversity.rarefaction(counts, diversity.ticks(counts.agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0]))


RECAPTURE_SIZES = [100 + (35000 - 100) * i // 49 for i in range(50)]
RECAPTURE = "SELECT region, CAST(m AS BIGINT) AS n, round(100 * (1 - power(1 - 1 / u, m)), 6) AS pct FROM (SELECT region, count(*)::DOUBLE AS u FROM ({0}) c GROUP BY 1) u, (SELECT unnest({1}) AS m) x"


@query("d2_recapture", f"SELECT n, pct FROM ({RECAPTURE.format(f"SELECT 'cdr3' AS region, * FROM ({CDR3}) c", RECAPTURE_SIZES)}) r")
def _(spark, d):
    return diversity.recapture(_cdr3(spark, d), RECAPTURE_SIZES)


@query("d1_sampled_richness")
def _(spark, d):
    return diversity.sampled_richness(_cdr3(spark, d), "aa", 100, [1, 2, 3])


@query("d3_weighted_recapture", f"WITH s AS ({CDR3}), t AS (SELECT CAST(sum(cnt) AS DOUBLE) AS total FROM s), x AS (SELECT unnest({RECAPTURE_SIZES}) AS m), q AS (SELECT m, 1 - power(1 - cnt / total, m) AS q FROM s, t, x) SELECT CAST(m AS BIGINT) AS n, round(100 * sum(q * q) / sum(q), 6) AS pct FROM q GROUP BY 1")
def _(spark, d):
    return diversity.weighted_recapture(_cdr3(spark, d), RECAPTURE_SIZES)


GROUPED = "WITH g AS (SELECT * FROM (VALUES " + ", ".join(f"('{g}', '{r}')" for g, rs in diversity.GROUPS.items() for r in rs) + ") v(grp, region)), t0 AS ({0}) SELECT g.grp, t0.* FROM t0 JOIN g USING (region)"


def _by_region(spark, d):
    return diversity.clonotypes(derived(spark, d, "clone_seqs"))


@query("d5_group_duplication", GROUPED.format(DUPLICATION.format(CLONES)))
def _(spark, d):
    return diversity.in_groups(diversity.duplication(_by_region(spark, d)))


@query("d5_group_recapture", GROUPED.format(RECAPTURE.format(CLONES, RECAPTURE_SIZES)))
def _(spark, d):
    return diversity.in_groups(diversity.region_recapture(_by_region(spark, d), RECAPTURE_SIZES))


@query("d5_group_rarefaction", GROUPED.format(RAREFACTION.format(CLONES, diversity.ticks(10**15))))
def _(spark, d):
    return diversity.in_groups(diversity.region_rarefaction(_by_region(spark, d)))


# ---------------------------------------------------------------- matrices and annotation
@query("f9_bound", "SELECT probe FROM hts WHERE experiment = 'click' AND value <= 20")
def _(spark, d):
    return hts.at_most(derived(spark, d, "hts"), "click", 20)


@query("f9_overexpressed", "SELECT probe FROM hts WHERE experiment = 'click' AND value >= 5")
def _(spark, d):
    return hts.at_least(derived(spark, d, "hts"), "click", 5)


@query("f9_bound_by", "SELECT DISTINCT experiment FROM hts WHERE value <= 5")
def _(spark, d):
    return hts.bound_by(derived(spark, d, "hts"), None, 5).distinct()


@query("f12_values", "SELECT probe, value FROM hts WHERE translate(experiment, '_', ' ') = 'click'")
def _(spark, d):
    return hts.values(derived(spark, d, "hts"), "click")


@query("j12_lookup", "WITH g AS (SELECT DISTINCT gene FROM annotation WHERE size <= 10), p AS (SELECT DISTINCT probe FROM hts) SELECT probe, CASE WHEN g.gene IS NULL THEN probe ELSE concat('gene ', g.gene) END AS mapped FROM p LEFT JOIN g ON g.gene = p.probe")
def _(spark, d):
    genes = derived(spark, d, "annotation").where("size <= 10").select(F.col("gene").alias("probe")).distinct()
    return hts.lookup(derived(spark, d, "hts").select("probe").distinct(), genes.withColumn("mapped", F.concat(F.lit("gene "), "probe")), "probe")


@query("a34_categories", "SELECT category, count(*) AS genes, string_agg(gene, ',' ORDER BY gene) AS members FROM (SELECT DISTINCT gene, category FROM annotation) a GROUP BY 1")
def _(spark, d):
    return hts.categories(derived(spark, d, "annotation"))


@query("a35_location", "SELECT experiment, round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd FROM hts GROUP BY 1")
def _(spark, d):
    return hts.location(derived(spark, d, "hts"), "value", "experiment").select("experiment", *(F.round(c, 6).alias(c) for c in ("median", "mean", "sd")))


@query("m42_nearest", "WITH p AS (SELECT probe AS id, experiment AS chrom, CAST(round(value * 100) AS BIGINT) AS pos FROM hts), m AS (SELECT DISTINCT chrom, pos AS mark FROM p WHERE pos % 97 = 0) SELECT id, chrom, pos, min(abs(pos - mark)) AS distance FROM p JOIN m USING (chrom) GROUP BY 1, 2, 3")
def _(spark, d):
    rows = derived(spark, d, "hts").select(F.col("probe").alias("id"), F.col("experiment").alias("chrom"), F.round(F.col("value") * 100).cast("long").alias("pos"))
    return hts.nearest(rows, rows.where("pos % 97 = 0").select("chrom", F.col("pos").alias("mark")).distinct())


@query("f10_bound_in_all", "SELECT probe FROM (SELECT probe FROM hts WHERE regexp_matches(experiment, '^c') GROUP BY probe HAVING bool_and(value <= 60)) a WHERE probe IN (SELECT probe FROM hts WHERE regexp_matches(experiment, 'view') GROUP BY probe HAVING bool_and(value >= 1))")
def _(spark, d):
    return _bound(spark, d)


def _bound(spark, d):
    rows = derived(spark, d, "hts")
    return filters.restrict(hts.bound_in_all(rows, ["^c"], 60), hts.bound_in_all(rows, ["~view"], 1), "probe")


@query("f11_experiments", "SELECT DISTINCT experiment FROM hts WHERE regexp_matches(experiment, 'i')")
def _(spark, d):
    return hts.experiments(derived(spark, d, "hts"), "i")


@query("o3_highest", "SELECT probe, value FROM (SELECT probe, value FROM hts WHERE experiment = 'click' ORDER BY value DESC, probe LIMIT 20) x WHERE value >= 10")
def _(spark, d):
    return hts.extremes(derived(spark, d, "hts"), "click", 20, threshold=10)


@query("o3_lowest", "SELECT probe, value FROM (SELECT probe, value FROM hts WHERE experiment = 'click' ORDER BY value, probe LIMIT 20) x WHERE value <= 10")
def _(spark, d):
    return hts.extremes(derived(spark, d, "hts"), "click", 20, lowest=True, threshold=10)


@query("n6_rank_pvalue", "SELECT round(greatest(count(*) FILTER (value > 30), 1)::DOUBLE / nullif(count(*), 0), 9) AS p FROM hts WHERE experiment = 'click'")
def _(spark, d):
    return hts.rank_pvalue(derived(spark, d, "hts"), "click", 30)


@query("a34_category_sizes", "SELECT size, count(*) AS categories FROM (SELECT category, count(DISTINCT gene) AS size FROM annotation GROUP BY 1) x GROUP BY 1")
def _(spark, d):
    return hts.category_sizes(derived(spark, d, "annotation").select("gene", "category"))


@query(
    "m23_enrichment",
    """WITH a AS (SELECT DISTINCT gene, category FROM annotation), t AS (SELECT count(DISTINCT gene) AS n, count(DISTINCT category) AS c FROM a), g AS (SELECT DISTINCT gene FROM annotation WHERE size <= 10),
    w AS (SELECT count(DISTINCT gene) AS d FROM a WHERE gene IN (SELECT gene FROM g)), p AS (SELECT category, count(*) FILTER (gene IN (SELECT gene FROM g)) AS found, count(*) AS size FROM a GROUP BY 1),
    l AS (SELECT p.*, n, c, d, list_sum(list_transform(range(found, least(d, p.size) + 1), lambda k: CASE WHEN d - k > n - p.size THEN 0 ELSE exp(lgamma(p.size + 1) - lgamma(k + 1) - lgamma(p.size - k + 1) + lgamma(n - p.size + 1) - lgamma(d - k + 1) - lgamma(n - p.size - d + k + 1) - lgamma(n + 1) + lgamma(d + 1) + lgamma(n - d + 1)) END)) AS tail FROM p, t, w WHERE found > 0)
    SELECT category, found, size, round(least(1, tail * c), 8) AS p FROM l""",
)
def _(spark, d):
    a = derived(spark, d, "annotation")
    return hts.enrichment(a.where("size <= 10").select("gene"), a.select("gene", "category")).withColumn("p", F.round("p", 8))


# ---------------------------------------------------------------- motifs
CANON = "least(w, reverse(translate(w, 'ACGTWSKMYRNacgtwskmyrn', 'TGCAWSMKRYNtgcawsmkryn')))"
KMERS = "SELECT unnest(list_transform(range(1, greatest(length(seq) - {k} + 2, 1)), lambda i: substring(upper(seq), i, {k}))) AS w FROM reads"


@query("a30_kmers", f"WITH k AS ({KMERS.format(k=6)}) SELECT {CANON} AS kmer, count(*) AS cnt FROM k WHERE NOT contains(w, 'N') GROUP BY 1")
def _(spark, d):
    return motifs.top_kmers(derived(spark, d, "reads"), 6)


@query("a30_top_kmers", f"WITH k AS ({KMERS.format(k=8)}) SELECT {CANON} AS kmer, count(*) AS cnt FROM k WHERE NOT contains(w, 'N') GROUP BY 1 ORDER BY cnt DESC, kmer LIMIT 100")
def _(spark, d):
    return motifs.top_kmers(derived(spark, d, "reads"), 8, 100)


@query("a32_site_histogram", "SELECT CAST(len(regexp_extract_all(upper(seq), 'AC[AG]T')) AS INT) AS n_sites, count(*) AS probes FROM reads GROUP BY 1")
def _(spark, d):
    return motifs.site_histogram(derived(spark, d, "reads"), S.iupac_regex("ACRT"))


BOTH = f"SELECT upper(seq) AS s FROM reads UNION ALL SELECT {RC.format('upper(seq)')} FROM reads"


@query("m31_markov", f"WITH b AS ({BOTH}), k AS (SELECT unnest(list_transform(range(1, greatest(length(s) - 1, 1)), lambda i: substring(s, i, 3))) AS kmer FROM b), c AS (SELECT kmer, count(*) AS cnt FROM k WHERE regexp_full_match(kmer, '[ACGT]+') GROUP BY 1) SELECT kmer, cnt, round((cnt + 1) / (sum(cnt) OVER (PARTITION BY substring(kmer, 1, 2)) + 4), 9) AS p FROM c")
def _(spark, d):
    return motifs.markov(derived(spark, d, "reads"), 2)


PFM = f"WITH x AS (SELECT {GENE.format('germline')} AS gene, fr1 AS seq FROM clone_seqs), w AS (SELECT gene, max(length(seq)) AS m FROM x GROUP BY 1) SELECT gene, CAST(i AS INT) AS pos, substring(rpad(seq, m::INT, '-'), i::INT + 1, 1) AS letter, count(*) AS cnt FROM x JOIN w USING (gene), range(25) r(i) WHERE i < m GROUP BY 1, 2, 3"


@query("a31_frequent_kmers", f"WITH k AS ({KMERS.format(k=6)}), c AS (SELECT {CANON} AS kmer, count(*) AS cnt FROM k GROUP BY 1) SELECT kmer, cnt FROM c WHERE cnt > (SELECT greatest(2, 0.1 * count(*)) FROM reads) AND length(replace(kmer, 'N', '')) >= 5")
def _(spark, d):
    return search.frequent_kmers(derived(spark, d, "reads"), 6)


@query("m3_consensus", f"SELECT gene, pos, letter, cnt FROM (SELECT *, row_number() OVER (PARTITION BY gene, pos ORDER BY cnt DESC, letter) AS rn FROM ({PFM}) p) q WHERE rn = 1")
def _(spark, d):
    return motifs.consensus(motifs.pfm(derived(spark, d, "clone_seqs").select(S.gene(F.col("germline")).alias("gene"), F.col("fr1").alias("seq")), "gene"), "gene")


UP_PFM = f"""u AS ({UPSTREAM}), x AS (SELECT {V_GENE} AS gene, upstream AS seq FROM u), l AS (SELECT gene, CAST(i - 1 AS INT) AS pos, substring(seq, i::INT, 1) AS letter FROM x, range(1, 21) r(i) WHERE i <= length(seq)),
    c AS (SELECT gene, pos, list_reverse_sort([{{'c': count(*) FILTER (letter = 'A'), 'b': 'A'}}, {{'c': count(*) FILTER (letter = 'C'), 'b': 'C'}}, {{'c': count(*) FILTER (letter = 'G'), 'b': 'G'}}, {{'c': count(*) FILTER (letter = 'T'), 'b': 'T'}}]) AS r FROM l WHERE letter IN ('A', 'C', 'G', 'T') GROUP BY 1, 2)"""
CODE_OF = "MAP {" + ", ".join(f"'{''.join(sorted(x))}': '{c}'" for c, x in S.IUPAC.items() if c != "U") + "}"
FIRST_BASES = "element_at({0}, list_aggregate(list_sort(list_transform(r[1:{1}], lambda x: x.b)), 'string_agg', ''))[1]"


@query("m3_degenerate_consensus", f"WITH {UP_PFM} SELECT gene, pos, CASE WHEN 2 * r[1].c > r[1].c + r[2].c + r[3].c + r[4].c AND r[1].c > 2 * r[2].c THEN r[1].b WHEN 4 * (r[1].c + r[2].c) > 3 * (r[1].c + r[2].c + r[3].c + r[4].c) THEN {FIRST_BASES.format(CODE_OF, 2)} WHEN r[4].c = 0 THEN {FIRST_BASES.format(CODE_OF, 3)} ELSE 'N' END AS letter FROM c")
def _(spark, d):
    rows = _upstream(spark, d).select(S.gene(F.col("vgene")).alias("gene"), F.col("upstream").alias("seq"))
    return motifs.degenerate_consensus(motifs.pfm(rows, "gene"), "gene")


def _gene_motifs(spark, d):
    """(id, fractions) of the upstream sequences of each V gene, written, as every pair and group of them reads it."""
    rows = _upstream(spark, d).select(S.gene(F.col("vgene")).alias("id"), F.col("upstream").alias("seq"))
    return written(trees.fractions_of(motifs.pfm(rows, "id"), "id"), "motifs")


def _gene_pairs(spark, d):
    """Distances between the V genes' motifs, within each family and among all."""
    grouped = trees.in_families(_gene_motifs(spark, d), S.family(F.col("id"), False))
    return grouped, distances.pair_distances(grouped)


@query("j9_motif_distances")
def _(spark, d):
    return _gene_pairs(spark, d)[1]


@query("m6_gene_trees")
def _(spark, d):
    """A tree of V genes for each family and one of all, as Newick texts."""
    grouped, pairs = _gene_pairs(spark, d)
    return trees.average_link(grouped.select("grp", F.col("id").alias("leaf")), pairs)[1]


@query("m6_gene_merges")
def _(spark, d):
    grouped, pairs = _gene_pairs(spark, d)
    return trees.average_link(grouped.select("grp", F.col("id").alias("leaf")), pairs)[0]


@query("m2_pfm", PFM)
def _(spark, d):
    return motifs.pfm(derived(spark, d, "clone_seqs").select(S.gene(F.col("germline")).alias("gene"), F.col("fr1").alias("seq")), "gene")


def _probes(spark, d):
    return derived(spark, d, "reads").select(F.col("read_id").alias("probe_id"), "seq")


def _subset(spark, d):
    return spark.read.parquet(f"{d}/labels.parquet").where("quality = 1").select(F.col("doc_id").alias("probe_id"))


@query("m17_pattern_enrichment", f"WITH h AS (SELECT read_id, regexp_matches(upper(seq), 'TGA[CGS]TCA') OR regexp_matches({RC.format('upper(seq)')}, 'TGA[CGS]TCA') AS hit, read_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS own FROM reads) SELECT count(*) FILTER (hit AND own) AS found, count(*) FILTER (own) AS draws, count(*) FILTER (hit) AS marked, count(*) AS total FROM h")
def _(spark, d):
    return motifs.enrichment(motifs.pattern_match(_probes(spark, d), "TGASTCA"), _subset(spark, d)).drop("p")


HITS = f"SELECT regexp_matches(upper(seq), 'TGA[CGS]TCA') OR regexp_matches({RC.format('upper(seq)')}, 'TGA[CGS]TCA') AS hit, read_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS own FROM reads"
TAIL = "list_sum(list_transform(range(found, least(draws, marked) + 1), lambda k: CASE WHEN draws - k > total - marked THEN 0 ELSE exp(lgamma(marked + 1) - lgamma(k + 1) - lgamma(marked - k + 1) + lgamma(total - marked + 1) - lgamma(draws - k + 1) - lgamma(total - marked - draws + k + 1) - lgamma(total + 1) + lgamma(draws + 1) + lgamma(total - draws + 1)) END))"


@query("m17_enrichment_p", f"WITH h AS ({HITS}), t AS (SELECT count(*) FILTER (hit AND own) AS found, count(*) FILTER (own) AS draws, count(*) FILTER (hit) AS marked, count(*) AS total FROM h) SELECT found, draws, marked, total, round(least(1, {TAIL}), 8) AS p FROM t")
def _(spark, d):
    return motifs.enrichment(motifs.pattern_match(_probes(spark, d), "TGASTCA"), _subset(spark, d)).withColumn("p", F.round("p", 8))


@query("f13_matching_probes", "SELECT read_id AS probe_id FROM reads WHERE regexp_matches(upper(seq), 'TGA[CG]TCA')")
def _(spark, d):
    return hts.matching_probes(_probes(spark, d), "TGA[CG]TCA")


@query("m18_best_threshold")
def _(spark, d):
    best = search.best_threshold(search.score_ratios(_probes(spark, d), _subset(spark, d), motifs.Motif.from_text("TGASTCA")))
    return spark.createDataFrame([best], "factor double, p double")


@query("m20_metrics")
def _(spark, d):
    return search.evaluate(_probes(spark, d), _subset(spark, d), {t: motifs.Motif.from_text(t) for t in ("TGASTCA", "ACGTRA")})


# Words of seven bases on either strand, their sites in each probe (those that begin inside one counted before left out), and tails.
SEVEN = f"""p AS (SELECT read_id, upper(seq) AS s, read_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS own FROM reads),
    k AS (SELECT read_id, own, s, unnest(range(1, greatest(length(s) - 5, 1))) AS pos FROM p),
    c AS (SELECT read_id, own, pos, {CANON} AS motif FROM (SELECT *, substring(s, pos, 7) AS w FROM k) x WHERE regexp_full_match(w, '[ACGT]+')),
    g AS (SELECT motif, read_id, any_value(own) AS own, list(pos ORDER BY pos) AS ps FROM c GROUP BY 1, 2),
    n AS (SELECT motif, own, len(ps) AS starts, list_reduce(list_transform(list_prepend(-99, ps), lambda x: {{'p': x, 'n': 0}}), lambda a, x: CASE WHEN x.p >= a.p + 7 THEN {{'p': x.p, 'n': a.n + 1}} ELSE a END).n AS sites FROM g),
    t AS (SELECT count(*) FILTER (own) AS draws, count(*) AS total, sum(CASE WHEN own THEN length(s) ELSE 0 END)::DOUBLE / sum(length(s)) AS part FROM p),
    a AS (SELECT motif, count(*) FILTER (own) AS found, count(*) AS marked, count(*) FILTER (own AND starts >= 2) AS f2, count(*) FILTER (starts >= 2) AS m2, coalesce(sum(least(sites, 2)) FILTER (own), 0) AS fr, sum(least(sites, 2)) AS mr, coalesce(sum(least(sites, 4)) FILTER (own), 0) AS fo, sum(least(sites, 4)) AS mo FROM n GROUP BY 1),
    l AS (SELECT motif, sites, count(*) FILTER (own) AS a, count(*) FILTER (NOT own) AS b FROM n GROUP BY 1, 2),
    u AS (SELECT *, sum(a) OVER w AS ua, sum(b) OVER w AS ub FROM l WINDOW w AS (PARTITION BY motif ORDER BY sites DESC)),
    r AS (SELECT motif, sum(a * (ua::DOUBLE / draws) / ((ua + ub)::DOUBLE / total)) AS cond, sum(a * (total - draws - ub + b / 2.0::DOUBLE)) AS wins, max(ua) AS ua, max(ub) AS ub FROM u, t GROUP BY 1)"""


def _tail_sql(found: str, draws: str, marked: str, total: str) -> str:
    terms = TAIL
    for name, value in (("found", found), ("draws", draws), ("marked", marked), ("total", total)):
        terms = re.sub(rf"\b{name}\b", f"@{name}@", terms)
    for name, value in (("found", found), ("draws", draws), ("marked", marked), ("total", total)):
        terms = terms.replace(f"@{name}@", f"({value})")
    return f"CASE WHEN {found} > 0 THEN least(1, {terms}) ELSE 1 END"


def _score_sql(p: str) -> str:
    return f"round(abs(log10(greatest({p}, 1e-299))), 4)"


OVER = "CASE WHEN fo > 0 THEN least(1, list_sum(list_transform(range(fo::BIGINT, mo::BIGINT + 1), lambda k: exp(lgamma(mo + 1) - lgamma(k + 1) - lgamma(mo - k + 1) + k * ln(part) + (mo - k) * ln(1 - part))))) ELSE 1 END"
METRIC_COLUMNS = ("probe", "site", "repeated", "over_represented")


@query(
    "m41_words",
    f"""WITH {SEVEN} SELECT motif, found, marked, draws, total, {_score_sql(_tail_sql("found", "draws", "marked", "total"))} AS probe, {_score_sql(_tail_sql("f2", "draws", "m2", "total"))} AS site, {_score_sql(_tail_sql("fr::BIGINT", "2 * draws", "mr::BIGINT", "2 * total"))} AS repeated, {_score_sql(OVER)} AS over_represented,
    round(found::DOUBLE / draws, 9) AS share, round((cond + draws - ua) / draws, 9) AS mncp, round((wins + (draws - ua) * (total - draws - ub) / 2.0::DOUBLE) / (draws * (total - draws)), 9) AS roc_auc FROM a JOIN r USING (motif), t""",
)
def _(spark, d):
    """Every word of seven bases that occurs, by all metrics, in one pass over the probes."""
    rows = motif_table.evaluate_all(_probes(spark, d), _subset(spark, d), motif_table.all_words(7))
    return rows.select("motif", "found", "marked", "draws", "total", *(motif_table.scores(F.col(c)).alias(c) for c in METRIC_COLUMNS), *(F.round(c, 9).alias(c) for c in ("share", "mncp", "roc_auc")))


@query("m41_gapped_words")
def _(spark, d):
    """Words of three letters, with an ambiguity code at most, beside themselves or their reverse complements, 0 to 11 letters apart."""
    return motif_table.evaluate_all(_probes(spark, d), _subset(spark, d), motif_table.texts(words.dimer_words(3)))


@query("m41_frequent_words")
def _(spark, d):
    """The hundred most frequent words of the subset for each width from 7 to 11, against all probes."""
    probes, subset = _probes(spark, d), _subset(spark, d)
    own = probes.join(subset, "probe_id", "left_semi")
    return motif_table.evaluate_all(probes, subset, motif_table.frequent_words(own, range(7, 12), 100))


@query("m41_best_thresholds")
def _(spark, d):
    named = {t: motifs.Motif.from_text(t) for t in ("TGASTCA", "ACGTRA", "GGCWTA", "TTACGG")}
    return motif_table.best_thresholds(_probes(spark, d), _subset(spark, d), named)


def _score_at(motif, text: str) -> tuple[str, str]:
    """Scores of a window on either strand, place by place, as the matrix has them."""
    at = lambda m: " + ".join(f"CASE substring({text}, {i + 1}, 1) " + " ".join(f"WHEN '{b}' THEN {x!r}::DOUBLE" for b, x in zip(motifs.BASES, row.tolist(), strict=True)) + " ELSE 0 END" for i, row in enumerate(m.ratios))
    return at(motif), at(motif.reverse())


def _scan_sql(named: dict[str, motifs.Motif], factor: float) -> str:
    one = lambda name, m: f"""SELECT read_id AS probe_id, '{name}' AS motif, CAST(p AS INT) AS start, CAST(p + {len(m)} AS INT) AS "end", greatest(f, b) AS score, CASE WHEN f >= b THEN '+' ELSE '-' END AS strand
    FROM (SELECT read_id, p, {_score_at(m, "w")[0]} AS f, {_score_at(m, "w")[1]} AS b FROM (SELECT read_id, p, substring(s, p::INT + 1, {len(m)}) AS w FROM (SELECT read_id, upper(seq) AS s, unnest(range(0, greatest(length(seq) - {len(m)} + 1, 0))) AS p FROM reads) x) y) z WHERE greatest(f, b) > {factor * m.best!r}::DOUBLE"""  # noqa: E731
    return " UNION ALL ".join(one(n, m) for n, m in named.items())


def _specificity_sql(motif: motifs.Motif, top: int = 100) -> str:
    forward, back = _score_at(motif, "substring(s, p::INT + 1, 7)")
    return f"""WITH x AS (SELECT read_id, upper(seq) AS s, unnest(range(0, greatest(length(seq) - {len(motif)} + 1, 0))) AS p FROM reads), y AS (SELECT read_id, max(greatest({forward}, {back})) AS score FROM x GROUP BY 1),
    z AS (SELECT r.read_id, coalesce(score, '-inf'::DOUBLE) AS score, r.read_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS own FROM reads r LEFT JOIN y USING (read_id)),
    h AS (SELECT own, score >= (SELECT min(score) FROM (SELECT score FROM z ORDER BY score DESC LIMIT {top + 1}) c) AS hit FROM z), t AS (SELECT count(*) FILTER (hit AND own) AS found, count(*) FILTER (own) AS draws, count(*) FILTER (hit) AS marked, count(*) AS total FROM h)
    SELECT found, draws, marked, total, round(least(1, {TAIL}), 8) AS p FROM t"""


SCANNED = {"tgastca": motifs.Motif.from_text("TGASTCA"), "acgtr": motifs.Motif.from_text("ACGTRA")}


@query("m12_scan", _scan_sql(SCANNED, 0.8))
def _(spark, d):
    return motifs.sitemap(_probes(spark, d), SCANNED, 0.8)


@query("m19_group_specificity", _specificity_sql(motifs.Motif.from_text("TGASTCA")))
def _(spark, d):
    scored = _probes(spark, d).select("probe_id", motifs.best_scorer(motifs.Motif.from_text("TGASTCA"))("seq").alias("score"))
    return motifs.group_specificity(scored, _subset(spark, d)).withColumn("p", F.round("p", 8))


@query("m22_rank_sum", "WITH s AS (SELECT n_chars AS v, lang = 'en' AS g FROM documents), r AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE AS r FROM s), a AS (SELECT count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n2, sum(CASE WHEN g THEN r ELSE 0 END) AS w FROM r) SELECT n1, n2, w, w - n1 * (n1 + 1) / 2.0::DOUBLE AS u, round((w - n1 * (n1 + 1) / 2.0::DOUBLE - n1 * n2 / 2.0::DOUBLE) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0::DOUBLE), 6) AS z, round((w - n1 * (n1 + 1) / 2.0::DOUBLE) / (n1::DOUBLE * n2), 9) AS auc FROM a")
def _(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select(F.col("n_chars").alias("v"), (F.col("lang") == "en").alias("g"))
    return stats.rank_sum(docs, "v", "g").select("n1", "n2", "w", "u", F.round("z", 6).alias("z"), F.round("auc", 9).alias("auc"))


@query("m30_em")
def _(spark, d):
    """Two seeds over all reads, to the end."""
    return em.em_table(derived(spark, d, "reads"), ["TGACTCA", "ACGTAC"])


@query("m38_discover")
def _(spark, d):
    """Motifs of the probes of the subset from its five most enriched words and a given seed, each scored among all probes."""
    return em.discover(_probes(spark, d), _subset(spark, d), 6, seeds=["TGACTCA"], enriched=5)


@query(
    "j9_pair_distances",
    """WITH p AS (SELECT label, generate_subscripts(embedding, 1) AS k, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, k, avg(x) AS x FROM p GROUP BY 1, 2)
    SELECT a.label AS i, b.label AS j, round(sqrt(sum((a.x - b.x) * (a.x - b.x))), 6) AS d FROM m a JOIN m b ON a.k = b.k AND a.label < b.label GROUP BY 1, 2""",
)
def _(spark, d):
    return _label_distances(spark, d)


def _label_distances(spark, d):
    """Distances between the mean vectors of the labels, a few rows however many vectors there are."""
    parts = spark.read.parquet(f"{d}/embeddings.parquet").select("label", F.posexplode("embedding").alias("k", "x"))
    mean = parts.groupBy("label", "k").agg(F.avg(F.col("x").cast("double")).alias("x"))
    pairs = mean.toDF("i", "k", "x").join(mean.toDF("j", "k", "y"), "k").where("i < j")
    return pairs.groupBy("i", "j").agg(F.round(F.sqrt(F.sum((F.col("x") - F.col("y")) * (F.col("x") - F.col("y")))), 6).alias("d"))


@query("m35_k_medoids")
def _(spark, d):
    """Runs over the motifs of all V genes."""
    return cluster.k_medoids_runs(_gene_pairs(spark, d)[1].where("grp = 'all'"), [2, 3, 4], [1, 2, 3])


@query("m37_fold_losses")
def _(spark, d):
    """Three hypotheses, refined with three pseudocounts or as they are, three folds and all costs."""
    named = {t: motifs.Motif.from_text(t, beta=0.1) for t in ("TGASTCA", "ACGTRA", "GGCWTA")}
    return classify.fold_losses(_probes(spark, d), _subset(spark, d), named, folds=3, betas=(0.05 / 0.95, 0.5, 2.0, None))


@query("f15_without_similar")
def _(spark, d):
    """Probes that stay when near duplicates of probes at least as long go."""
    return similar.without_similar(_probes(spark, d)).select("probe_id", F.length("seq").alias("length"))


@query("o2_by_value", "SELECT value, cnt, row_number() OVER (ORDER BY value) AS place FROM (SELECT alignlen AS value, count(*) AS cnt FROM clone_annot GROUP BY 1) x")
def _(spark, d):
    """A distribution in the order of its values."""
    return abundance.placed(annot(spark, d).groupBy(F.col("alignlen").alias("value")).agg(F.count("*").alias("cnt")), "value")


@query("o2_by_count", "SELECT value, cnt, row_number() OVER (ORDER BY cnt DESC, value) AS place FROM (SELECT alignlen AS value, count(*) AS cnt FROM clone_annot GROUP BY 1) x")
def _(spark, d):
    """A distribution from its most frequent value to its least, ties by value."""
    return abundance.placed(annot(spark, d).groupBy(F.col("alignlen").alias("value")).agg(F.count("*").alias("cnt")), "value", by_count=True)


@query("o4_sorted_motifs", f"WITH k AS ({KMERS.format(k=6)}), c AS (SELECT {CANON} AS kmer, count(*) AS cnt FROM k WHERE NOT contains(w, 'N') GROUP BY 1) SELECT kmer, cnt, row_number() OVER (ORDER BY cnt, kmer DESC) AS place FROM c")
def _(spark, d):
    """Words by a property, here their number, in ascending order."""
    return abundance.placed(motifs.top_kmers(derived(spark, d, "reads"), 6), "kmer", order=[("cnt", True), ("kmer", False)])


@query("o5_enzymes_by_molecules", f"WITH h AS ({_hits_sql()}) SELECT enzyme, count(*) AS molecules, row_number() OVER (ORDER BY count(*), enzyme) AS place FROM h GROUP BY 1")
def _(spark, d):
    rows = restriction.hits(derived(spark, d, "reads"), SITES).groupBy("enzyme").agg(F.count("*").alias("molecules"))
    return abundance.placed(rows, "enzyme", order=[("molecules", True), ("enzyme", True)])


MOTIF_SETS = f"""WITH u AS ({UPSTREAM}), k AS (SELECT vgene, upper(upstream) AS s, CASE WHEN length(upstream) NOT BETWEEN 20 AND 20 THEN 'ignored'
    WHEN contains(upper(upstream), 'N') OR regexp_matches(substring(upper(upstream), 4), '^(...)*(TAA|TAG|TGA)') THEN 'faulty' WHEN NOT starts_with(upper(upstream), 'ATG') THEN 'untranslated' ELSE 'dna' END AS kind FROM u),
    x AS (SELECT vgene, kind, s FROM k WHERE kind <> 'ignored' UNION ALL SELECT vgene, 'protein', list_aggregate(list_transform(range(1, length(s) - 1, 3), lambda i: coalesce(element_at({CODE_SQL}, substring(s, i, 3))[1], 'X')), 'string_agg', '') FROM k WHERE kind = 'dna'),
    l AS (SELECT vgene, kind, CAST(i - 1 AS INT) AS pos, substring(s, i::INT, 1) AS letter FROM x, range(1, 21) r(i) WHERE i <= length(s))
    SELECT 'variant' AS level, vgene AS name, kind, pos, letter, count(*) AS cnt FROM l GROUP BY ALL UNION ALL SELECT 'gene', {V_GENE}, kind, pos, letter, count(*) FROM l GROUP BY ALL UNION ALL SELECT 'family', {PLAIN_FAMILY}, kind, pos, letter, count(*) FROM l GROUP BY ALL"""


@query("m5_upstream_motifs", MOTIF_SETS)
def _(spark, d):
    """Motifs of secretion signals of exactly 20 bases by variant, gene and family: valid, translated, faulty and without a start."""
    return upstream.motif_counts(upstream.classify(_upstream(spark, d), "secsig", (20, 20)))


BAD_PROBES = "SELECT DISTINCT probe FROM hts WHERE experiment = 'error' AND value <= 1"
SELECTED = """WITH s AS ({0}), b AS ({1}), g AS (SELECT experiment FROM s WHERE probe IN (SELECT probe FROM b) GROUP BY 1 HAVING count(*) > 2)
    SELECT experiment, probe, value, CAST(row_number() OVER (PARTITION BY experiment ORDER BY value, probe) AS INT) AS place FROM s WHERE probe NOT IN (SELECT probe FROM b) OR experiment NOT IN (SELECT experiment FROM g)"""


def _bad(spark, d):
    return derived(spark, d, "hts").where("experiment = 'error' AND value <= 1").select("probe")


@query("o6_top_probes", SELECTED.format("SELECT experiment, probe, value FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY value, probe) AS k FROM hts) x WHERE k <= 12", BAD_PROBES))
def _(spark, d):
    return hts.selected(derived(spark, d, "hts"), _bad(spark, d), top=12)


@query("o6_bound_probes", SELECTED.format("SELECT experiment, probe, value FROM hts WHERE value <= 0.5", BAD_PROBES))
def _(spark, d):
    return hts.selected(derived(spark, d, "hts"), _bad(spark, d), most=0.5)


@query("o6_ratio_probes", SELECTED.format("SELECT experiment, probe, value FROM hts WHERE value >= 8", BAD_PROBES))
def _(spark, d):
    return hts.selected(derived(spark, d, "hts"), _bad(spark, d), ratio=8)


@query("a27_indelled_genes")
def _(spark, d):
    """V genes and families of the reads whose 5' primer has an indel."""
    return primer.indelled_genes(_with_primers(spark, d, "5"), "5")


@query("m2_aligned_pfm")
def _(spark, d):
    """Letters and gaps at each place of an alignment of up to 20 different upstream sequences of each V gene."""
    rows = _upstream(spark, d).select(S.gene(F.col("vgene")).alias("gene"), F.col("upstream").alias("seq"))
    return motifs.pfm(motifs.aligned(rows, "gene").select("gene", F.col("aligned").alias("seq")), "gene")


def _spans(spark, d):
    """Annotations as spans on a chromosome a family, by their part's number."""
    start = F.split("queryid", "-")[2].cast("long") * 250
    return annot(spark, d).select(F.col("queryid").alias("id"), F.split("vgene", "-")[0].alias("chrom"), start.alias("start"), (start + F.col("alignlen")).alias("end"))


@query(
    "m42_merged_spans",
    """WITH s AS (SELECT split_part(vgene, '-', 1) AS chrom, CAST(split_part(queryid, '-', 3) AS BIGINT) * 250 AS a, CAST(split_part(queryid, '-', 3) AS BIGINT) * 250 + alignlen AS b FROM clone_annot),
    o AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY chrom ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS begins FROM s),
    u AS (SELECT *, sum(begins) OVER (PARTITION BY chrom ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM o)
    SELECT chrom, min(a) AS start, max(b) AS "end", count(*) AS spans FROM u GROUP BY chrom, k""",
)
def _(spark, d):
    return intervals.merged(_spans(spark, d))


@query(
    "j5_overlapping_spans",
    """WITH s AS (SELECT queryid AS id, split_part(vgene, '-', 1) AS chrom, vgene, CAST(split_part(queryid, '-', 3) AS BIGINT) * 250 AS a, CAST(split_part(queryid, '-', 3) AS BIGINT) * 250 + alignlen AS b, strand FROM clone_annot)
    SELECT x.chrom, count(*) AS pairs, CAST(sum(least(x.b, y.b) - greatest(x.a, y.a)) AS BIGINT) AS shared FROM s x JOIN s y ON x.chrom = y.chrom AND x.a < y.b AND y.a < x.b AND x.strand = 'reversed' AND y.strand = 'forward' AND x.vgene = y.vgene GROUP BY 1""",
)
def _(spark, d):
    """Spans on the reverse strand with those on the forward strand that they overlap, of one gene variant."""
    rows = annot(spark, d)
    start = F.split("queryid", "-")[2].cast("long") * 250
    spans = rows.select("strand", F.col("vgene").alias("chrom"), start.alias("start"), (start + F.col("alignlen")).alias("end"))
    alike = spans.groupBy("strand", "chrom", "start", "end").agg(F.count("*").alias("n"))
    met = intervals.overlapping(alike.where("strand = 'reversed'"), alike.where("strand = 'forward'"))
    shared, n = F.least("end", "b_end") - F.greatest("start", "b_start"), F.col("n") * F.col("b_n")
    return met.groupBy(F.split("chrom", "-")[0].alias("chrom")).agg(F.sum(n).alias("pairs"), F.sum(shared * n).alias("shared"))


@query("m16_neighbourhoods")
def _(spark, d):
    """The stretches within ten letters of a site of a motif."""
    probes = _probes(spark, d)
    sites = motifs.sitemap(probes, {"acgtr": motifs.Motif.from_text("ACGTRA")}, 0.8).select("probe_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    return intervals.neighbourhoods(sites, probes, 10)

"""Repertoire tables derived from the driver's tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CLONE_ANNOT = """
SELECT queryid, vgene, dgene, jgene, chain, strand, stopcodon, v_j_frame, bitscore, identity, alignlen, vstart, vqstart, vmismatches, vgaps,
       fr1_start, fr1_start+f1-1 AS fr1_end, fr1_start+f1 AS cdr1_start, fr1_start+f1+23 AS cdr1_end,
       fr1_start+f1+24 AS fr2_start, fr1_start+f1+74 AS fr2_end, fr1_start+f1+75 AS cdr2_start, fr1_start+f1+98 AS cdr2_end,
       fr1_start+f1+99 AS fr3_start, fr1_start+f1+212 AS fr3_end, fr1_start+f1+213 AS cdr3_start,
       fr1_start+f1+212+c3 AS cdr3_end,
       CASE WHEN no4 THEN NULL ELSE fr1_start+f1+213+c3 END AS fr4_start,
       CASE WHEN no4 THEN NULL ELSE fr1_start+f1+212+c3+33 END AS fr4_end,
       dmismatches, dgaps, jmismatches, jgaps, jqend, fr1_gaps, fr1_mismatches, cdr1_gaps, cdr1_mismatches, fr2_gaps, fr2_mismatches,
       cdr2_gaps, cdr2_mismatches, fr3g_gaps, fr3g_mismatches, cdr3g_gaps, cdr3g_mismatches
FROM (
  SELECT concat(l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey) AS queryid,
         concat('IGHV',1+l_partkey%7,'-',1+l_suppkey%10,
                CASE WHEN l_partkey%11=0 THEN 'D' WHEN l_partkey%13=0 THEN '/OR15' ELSE '' END,'*0',1+l_linenumber%4) AS vgene,
         CASE WHEN l_orderkey%17=0 THEN NULL ELSE concat('IGHD',1+l_partkey%6,'-',1+l_orderkey%9,'*01') END AS dgene,
         CASE WHEN l_orderkey%23=0 THEN NULL ELSE concat('IGHJ',1+l_suppkey%6,'*0',1+l_orderkey%2) END AS jgene,
         'VH' AS chain,
         CASE WHEN l_linenumber=7 THEN 'reversed' ELSE 'forward' END AS strand,
         CASE WHEN l_linestatus='F' THEN 'Yes' ELSE 'No' END AS stopcodon,
         CASE WHEN l_returnflag='R' THEN 'Out-of-frame' WHEN l_returnflag='A' AND l_partkey%5=0 THEN 'N/A' ELSE 'In-frame' END AS v_j_frame,
         CAST(200+CAST(floor(l_extendedprice/100) AS INT)%400 AS DOUBLE) AS bitscore,
         CAST(80+l_orderkey%20 AS DOUBLE) AS identity,
         CAST(225+l_quantity*2 AS INT) AS alignlen,
         CAST(1+l_linenumber%5 AS INT) AS vstart,
         CAST(1+l_partkey%40 AS INT) AS vqstart,
         CAST(round(l_discount*100) AS INT) AS vmismatches,
         CAST(round(l_tax*100) AS INT) AS vgaps,
         CAST(greatest((1+l_partkey%40)-(1+l_linenumber%5),0)+1 AS INT) AS fr1_start,
         CAST(CASE WHEN l_suppkey%8=0 THEN 72 ELSE 75 END AS INT) AS f1,
         CAST(24+3*(l_orderkey%12) AS INT) AS c3,
         CAST(CASE WHEN l_orderkey%17=0 THEN NULL ELSE l_suppkey%5 END AS INT) AS dmismatches,
         CAST(CASE WHEN l_orderkey%17=0 THEN NULL ELSE l_partkey%3 END AS INT) AS dgaps,
         CAST(CASE WHEN l_orderkey%23=0 THEN NULL ELSE l_partkey%6 END AS INT) AS jmismatches,
         CAST(CASE WHEN l_orderkey%23=0 THEN NULL ELSE l_suppkey%2 END AS INT) AS jgaps,
         CAST(CASE WHEN l_orderkey%23=0 THEN NULL ELSE 330+l_partkey%40 END AS INT) AS jqend,
         CAST(CASE WHEN l_orderkey%31=0 THEN NULL WHEN l_orderkey%9=0 THEN 3 ELSE 0 END AS INT) AS fr1_gaps,
         CAST(l_linenumber%4 AS INT) AS fr1_mismatches,
         CAST(CASE WHEN l_partkey%14=0 THEN 1 ELSE 0 END AS INT) AS cdr1_gaps,
         CAST(l_partkey%7 AS INT) AS cdr1_mismatches,
         CAST(CASE WHEN l_suppkey%15=0 THEN 3 ELSE 0 END AS INT) AS fr2_gaps,
         CAST(l_suppkey%3 AS INT) AS fr2_mismatches,
         CAST(CASE WHEN l_suppkey%16=0 THEN 2 ELSE 0 END AS INT) AS cdr2_gaps,
         CAST(l_orderkey%5 AS INT) AS cdr2_mismatches,
         CAST(CASE WHEN l_orderkey%18=0 THEN 6 ELSE 0 END AS INT) AS fr3g_gaps,
         CAST(l_orderkey%4 AS INT) AS fr3g_mismatches,
         CAST(CASE WHEN l_orderkey%2=0 THEN NULL ELSE l_orderkey%3 END AS INT) AS cdr3g_gaps,
         CAST(CASE WHEN l_orderkey%2=0 THEN NULL ELSE l_orderkey%8 END AS INT) AS cdr3g_mismatches,
         l_partkey%19=0 AS no4
  FROM {lineitem}) d
"""
READS = """
SELECT doc_id AS read_id, lang AS sample,
       translate(regexp_replace(lower(text),'[^a-z]',''{g}),'abcdefghijklmnopqrstuvwxyz','ACGTAGCTTACGGATCCATGCGTAAC') AS seq
FROM {documents}
"""
CLONE_SEQS = """
SELECT doc_id AS queryid, concat('IGHV',1+doc_id%7,'-',1+doc_id%10,'*01') AS germline,
       substring(aa,1,25) AS fr1, substring(aa,26,8) AS cdr1, substring(aa,34,17) AS fr2, substring(aa,51,8) AS cdr2,
       substring(aa,59,38) AS fr3, substring(aa,97,13) AS cdr3, substring(aa,110,11) AS fr4
FROM (SELECT doc_id, translate(regexp_replace(lower(text),'[^a-z]',''{g}),'abcdefghijklmnopqrstuvwxyz','ACDEFGHIKLMNPQRSTVWY*AGSLV') AS aa FROM {documents}) d
"""
HTS = "SELECT event_type AS experiment, cast(user_id AS {string}) AS probe, min(value) AS value FROM {events} GROUP BY 1, 2"
ANNOTATION = "SELECT cast(p_partkey AS {string}) AS gene, p_type AS category, p_size AS size FROM {part}"
TABLES = {"clone_annot": (CLONE_ANNOT, "lineitem"), "reads": (READS, "documents"), "clone_seqs": (CLONE_SEQS, "documents"), "hts": (HTS, "events"), "annotation": (ANNOTATION, "part")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, source = TABLES[name]
    return spark.sql(sql.format(g="", string="string", **{source: "{source}"}), source=spark.read.parquet(f"{sf_dir}/{source}.parquet"))


def oracle(sql: str) -> str:
    """SQL for DuckDB with the derived tables it names as common table expressions."""
    own = [f"{n} AS ({t.format(g=', ' + repr('g'), string='varchar', **{s: s})})" for n, (t, s) in TABLES.items() if n in sql]
    sql = sql.strip()
    if not own:
        return sql
    head = "WITH " + ", ".join(own)
    return f"{head}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"{head} {sql}"

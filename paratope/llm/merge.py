"""Three-way merge of two branches of a table: DuckDB inside each task joins the versions of a run of ids and puts texts together.

A branch is a change log against the base: rows added or dropped, columns edited, lines edited or dropped, and lines inserted in
the gap after a line. Base and logs are dealt to hash partitions by id, so that added rows, whose ids are new, lie where the other
branch's do. There they are sorted by id and read in runs of bounded bytes. Each run is registered with DuckDB as Arrow tables; full
joins line up rows, lines and gaps of the three versions, and an ordered string aggregation gives the merged texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paratope.llm.common import release, tidy

#: What a change does: drop a line, put a text in its place, or insert a text in the gap after it (-1: before the first).
DROP, EDIT, INSERT = 0, 1, 2
#: What a row of a log is: changes of a row of the base, the end of one, or a new one.
CHANGED, DROPPED, ADDED = 0, 1, 2
CHANGES = "array<struct<line:int,op:int,text:string>>"
COUNTS = ("n_clean", "n_edit_edit", "n_edit_delete", "n_insert_insert")
RUN_BYTES = 8 << 20  # of Arrow data that DuckDB joins at once

_BASE, _LEFT, _RIGHT = 0, 1, 2


def _sql(width: int) -> str:
    """Merged rows of a registered run: v (k, version, kind, c0.., text, changes), at most one row of a kind a version and k."""
    cols = [f"c{i}" for i in range(width)]
    state = lambda v, name: f"""{name} AS (SELECT k, bool_or(kind = {DROPPED}) AS gone, bool_or(kind = {ADDED}) AS made, {"".join(f"max({c}) FILTER (kind = {CHANGED}) AS {c}, max({c}) FILTER (kind = {ADDED}) AS a{c}, " for c in cols)}
    max(text) FILTER (kind = {ADDED}) AS atext FROM v WHERE version = {v} GROUP BY k)"""  # noqa: E731
    changed = lambda s, c: f"({s}.{c} IS NOT NULL AND {s}.{c} <> coalesce(b.{c}, ''))"
    any_column = lambda s: " OR ".join([*(changed(s, c) for c in cols), "FALSE"])
    both_differ = lambda c: f"({changed('l', c)} AND {changed('r', c)} AND l.{c} <> r.{c})"
    total = lambda terms: " + ".join([*terms, "0"])
    same_added = " AND ".join(["l.atext IS NOT DISTINCT FROM r.atext", *(f"l.a{c} IS NOT DISTINCT FROM r.a{c}" for c in cols)])
    picked = [f"""CASE WHEN h.here THEN CASE WHEN NOT r_kept THEN NULL WHEN {changed("r", c)} THEN r.{c} WHEN l_kept AND {changed("l", c)} THEN l.{c} ELSE coalesce(b.{c}, '') END
        WHEN r.made THEN r.a{c} ELSE l.a{c} END AS {c}""" for c in cols]  # fmt: skip
    return f"""
WITH b AS (SELECT k, {"".join(f"{c}, " for c in cols)}coalesce(text, '') AS text FROM v WHERE version = {_BASE}),
{state(_LEFT, "l")},
{state(_RIGHT, "r")},
h AS (
  SELECT coalesce(b.k, l.k, r.k) AS k, b.k IS NOT NULL AS here, NOT coalesce(l.gone, FALSE) AS l_kept, NOT coalesce(r.gone, FALSE) AS r_kept
  FROM b FULL JOIN l ON b.k = l.k FULL JOIN r ON coalesce(b.k, l.k) = r.k
),
own AS (SELECT k, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM b),
e AS (SELECT k, version, unnest(changes, recursive := true) FROM v WHERE version <> {_BASE} AND kind = {CHANGED}),
el AS (SELECT e.k, line, op = {INSERT} AS gap, any_value(op) AS op, max(text) AS text FROM e JOIN h ON e.k = h.k AND l_kept WHERE version = {_LEFT} GROUP BY 1, 2, 3),
er AS (SELECT e.k, line, op = {INSERT} AS gap, any_value(op) AS op, max(text) AS text FROM e JOIN h ON e.k = h.k AND r_kept WHERE version = {_RIGHT} GROUP BY 1, 2, 3),
base AS (SELECT k, line, FALSE AS gap, text FROM own),
met AS (
  SELECT coalesce(base.k, el.k, er.k) AS k, coalesce(base.line, el.line, er.line) AS line, coalesce(base.gap, el.gap, er.gap) AS gap, base.text AS text,
         el.op AS lo, el.text AS lt, er.op AS ro, er.text AS rt,
         el.k IS NOT NULL AND NOT coalesce(el.op = {EDIT} AND el.text = base.text, FALSE) AS lc,
         er.k IS NOT NULL AND NOT coalesce(er.op = {EDIT} AND er.text = base.text, FALSE) AS rc
  FROM base FULL JOIN el ON base.k = el.k AND base.line = el.line AND base.gap = el.gap
       FULL JOIN er ON coalesce(base.k, el.k) = er.k AND coalesce(base.line, el.line) = er.line AND coalesce(base.gap, el.gap) = er.gap
  WHERE base.k IS NOT NULL OR coalesce(el.gap, er.gap)
),
texts AS (
  SELECT k, bool_or(lc) AS lc, bool_or(rc) AS rc,
         string_agg(CASE WHEN rc THEN CASE WHEN ro <> {DROP} THEN rt END WHEN lc THEN CASE WHEN lo <> {DROP} THEN lt END ELSE text END, chr(10) ORDER BY line, gap) AS text,
         count(*) FILTER (lc <> rc OR (lc AND rc AND lo = ro AND lt IS NOT DISTINCT FROM rt)) AS clean,
         count(*) FILTER (lc AND rc AND lo = {EDIT} AND ro = {EDIT} AND lt <> rt) AS ee,
         count(*) FILTER (lc AND rc AND lo <> ro) AS ed,
         count(*) FILTER (lc AND rc AND lo = {INSERT} AND ro = {INSERT} AND lt <> rt) AS ii
  FROM met GROUP BY k
),
decided AS (
  SELECT h.k AS k, h.here AS here, l_kept AND r_kept AS kept, {", ".join([*picked, "0 AS none"])},
         CASE WHEN h.here THEN CASE WHEN l_kept AND r_kept THEN coalesce(t.text, '') WHEN r_kept AND (t.rc OR {any_column("r")}) THEN coalesce(t.text, '') END
              WHEN coalesce(r.made, FALSE) THEN coalesce(r.atext, '') WHEN coalesce(l.made, FALSE) THEN coalesce(l.atext, '') END AS text,
         NOT h.here AND (coalesce(l.made, FALSE) OR coalesce(r.made, FALSE)) AS made,
         coalesce(l.made, FALSE) AND coalesce(r.made, FALSE) AND NOT ({same_added}) AS clash,
         (NOT l_kept AND r_kept AND (t.rc OR {any_column("r")})) OR (NOT r_kept AND l_kept AND (t.lc OR {any_column("l")})) AS fought,
         t.clean + {total(f"CAST(({changed('l', c)} OR {changed('r', c)}) AND NOT {both_differ(c)} AS INT)" for c in cols)} AS clean,
         t.ee + {total(f"CAST({both_differ(c)} AS INT)" for c in cols)} AS ee, t.ed AS ed, t.ii AS ii
  FROM h LEFT JOIN b USING (k) LEFT JOIN l USING (k) LEFT JOIN r USING (k) LEFT JOIN texts t USING (k)
)
SELECT k, {"".join(f"CASE WHEN text IS NOT NULL THEN coalesce({c}, '') END AS {c}, " for c in cols)}text,
       CAST(CASE WHEN made THEN CAST(NOT clash AS INT) WHEN kept THEN clean ELSE CAST(NOT fought AS INT) END AS BIGINT) AS n_clean,
       CAST(CASE WHEN made OR NOT kept THEN 0 ELSE ee END AS BIGINT) AS n_edit_edit,
       CAST(CASE WHEN made THEN 0 WHEN kept THEN ed ELSE CAST(fought AS INT) END AS BIGINT) AS n_edit_delete,
       CAST(CASE WHEN made THEN CAST(clash AS INT) WHEN kept THEN ii ELSE 0 END AS BIGINT) AS n_insert_insert
FROM decided WHERE here OR made"""


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Sorted rows as tables of about ``most`` bytes that hold all rows of their ids (column 0)."""
    held: list[pa.Table] = []
    size = 0

    def cut(whole: pa.Table, last: bool) -> tuple[pa.Table, pa.Table]:
        """The rows before the last id, which may go on, and the rest."""
        if last or not whole.num_rows:
            return whole, whole.slice(whole.num_rows)
        ids = whole.column(0).combine_chunks()
        end, n = ids[-1].as_py(), whole.num_rows
        while n and ids[n - 1].as_py() == end:
            n -= 1
        return whole.slice(0, n), whole.slice(n)

    for b in batches:
        step = max(1, int(b.num_rows * most / max(1, b.nbytes)))
        for lo in range(0, b.num_rows, step):
            part = pa.Table.from_batches([b.slice(lo, step)])
            held.append(part)
            size += part.nbytes
            if size >= most:
                done, rest = cut(pa.concat_tables(held).combine_chunks(), False)
                held, size = [rest], rest.nbytes
                if done.num_rows:
                    yield done
                del done
    if held:
        done, _ = cut(pa.concat_tables(held).combine_chunks(), True)
        if done.num_rows:
            yield done


def _numbered(table: pa.Table) -> tuple[pa.Table, pa.Array]:
    """The run with its ids numbered from 0 (null is an id too) and without later rows of one id, version and kind; the ids."""
    ids = table.column("id").combine_chunks()
    null = np.asarray(ids.is_null())
    x = np.asarray(ids.fill_null(0))
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (null[1:] != null[:-1])
    k = np.cumsum(new) - 1
    key = np.stack([k, np.asarray(table.column("version")), np.asarray(table.column("kind"))])
    first = np.ones(len(x), dtype=bool)
    first[1:] = (key[:, 1:] != key[:, :-1]).any(0)
    out = table.drop_columns(["id"]).append_column("k", pa.array(k, pa.int64())).filter(pa.array(first))
    return out, ids.filter(pa.array(new))


def merge_branches(base: DataFrame, left: DataFrame, right: DataFrame, columns: Sequence[str] = ("lang", "source"), key: str = "doc_id") -> DataFrame:
    """Merge two change logs of a base table; where both change the same thing in different ways, ``right`` holds.

    ``base`` has ``key`` (long), text and ``columns`` (strings). A log has ``key``, ``kind`` (CHANGED, DROPPED or ADDED),
    ``columns``, text and ``changes`` (CHANGES). A CHANGED row has new column values (null: as they were) and changes of lines, which
    count from 0 in the base's text cut at line feeds; an ADDED row has whole columns and a whole text. Returns (key, columns,
    text, n_clean, n_edit_edit, n_edit_delete, n_insert_insert), a row for each id of the base or added; those that no longer exist
    have null columns and text.

    Columns, lines and gaps are merged one by one: a change of one side, or the same one of both, is clean; two edits, an edit and
    a drop, or two insertions conflict. A dropped row counts alone: as a conflict if the other side keeps it with changes, else as
    clean. A change to the value that was there is none. Null columns and texts of the base count as empty. A null key is a key
    like others. Of rows that repeat a key the least (columns, text) stands for all; so it does in a log for each kind. Additions
    of an id that the base has, changes of one it hasn't and changes of lines past the end are ignored. Other columns are ignored;
    empty tables give the rows of the rest. A task holds RUN_BYTES of rows, or one row if that is longer.
    """
    names = [f"c{i}" for i in range(len(columns))]

    def rows(df: DataFrame, version: int, kind: Column, changes: Column) -> DataFrame:
        own = [F.col(c).cast("string").alias(n) for c, n in zip(columns, names, strict=True)]
        return df.select(F.col(key).cast("long").alias("id"), F.lit(version).alias("version"), kind.cast("int").alias("kind"), *own, F.col("text").cast("string").alias("text"), changes.alias("changes"))

    log = lambda df, version: rows(df, version, F.col("kind"), F.col("changes").cast(CHANGES))
    all_ = rows(base, _BASE, F.lit(0), F.lit(None).cast(CHANGES)).unionByName(log(left, _LEFT)).unionByName(log(right, _RIGHT))
    dealt = all_.repartition("id").sortWithinPartitions("id", "version", "kind", *names, "text")
    sql = _sql(len(names))

    def run(batches):
        release()
        con = duckdb.connect()
        con.execute("SET threads = 1")
        for table in _runs(batches, RUN_BYTES):
            v, ids = _numbered(table)
            con.register("v", v)
            out = con.sql(sql).to_arrow_table()
            con.unregister("v")
            out = out.set_column(0, "id", ids.take(out.column("k").combine_chunks()))
            for c in (*names, "text"):  # plain strings, as Spark reads them
                i = out.schema.get_field_index(c)
                out = out.set_column(i, c, out.column(c).cast(pa.string()))
            yield from out.to_batches(max_chunksize=4096)
            del table, v, out
        con.close()
        tidy()

    made = dealt.mapInArrow(run, f"id long, {''.join(f'{n} string, ' for n in names)}text string, {', '.join(f'{c} long' for c in COUNTS)}")
    return made.select(F.col("id").alias(key), *(F.col(n).alias(c) for n, c in zip(names, columns, strict=True)), "text", *COUNTS)


# ---------------------------------------------------------------- branches by rule
def coded_branch(docs: DataFrame, branch: str, columns: Sequence[str] = ("lang", "source")) -> DataFrame:
    """The change log of a branch of ``docs`` (doc_id, text, columns) whose changes follow from codes: crc32 of
    ``branch:doc_id:name`` modulo 7 for the row, each column and each line.

    0 drops the row or line and empties the column; 1 and 2 append ! or ? to columns and lines; 3 and 4 insert a line ! or ? after
    the line, and add a row -1 - doc_id of that text with the row's columns. A row with a null id has no changes.
    """
    code = lambda name: F.crc32(F.concat(F.lit(f"{branch}:"), F.col("doc_id").cast("string"), F.lit(":"), name).cast("binary")) % 7
    own = docs.where("doc_id IS NOT NULL").select("doc_id", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns), F.coalesce("text", F.lit("")).alias("text")).withColumn("row", code(F.lit("row")))
    edited = lambda c, value: F.when(c == 0, F.lit("")).when(c == 1, F.concat(value, F.lit("!"))).when(c == 2, F.concat(value, F.lit("?")))
    mark = lambda c: F.when((c == 1) | (c == 3), F.lit("!")).otherwise(F.lit("?"))

    def change(line: Column, i: Column) -> Column:
        """Bound as a lambda's variable, so that a line's code is computed once."""
        one = lambda c: F.struct(
            i.alias("line"), F.when(c == 0, DROP).when(c <= 2, EDIT).otherwise(INSERT).alias("op"), F.when(c == 0, F.lit(None)).when(c <= 2, F.concat(line, mark(c))).otherwise(mark(c)).alias("text")
        )
        return F.transform(F.filter(F.array(code(i.cast("string"))), lambda c: c <= 4), one)

    lines = F.flatten(F.transform(F.split("text", "\n", -1), change)).cast(CHANGES)
    none = F.array().cast(CHANGES)
    kept = own.select("doc_id", F.when(F.col("row") == 0, DROPPED).otherwise(CHANGED).alias("kind"), *(edited(code(F.lit(c)), F.col(c)).alias(c) for c in columns), F.lit(None).cast("string").alias("text"), F.when(F.col("row") == 0, none).otherwise(lines).alias("changes"))
    added = own.where(F.col("row").isin(3, 4)).select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(ADDED).alias("kind"), *columns, mark(F.col("row")).alias("text"), none.alias("changes"))
    return kept.unionByName(added)


def merged_branches(docs: DataFrame) -> DataFrame:
    """The merge of the coded branches L and R of ``docs``, with the SHA-256 of each text in place of it."""
    merged = merge_branches(docs, coded_branch(docs, "L"), coded_branch(docs, "R"))
    return merged.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"), *COUNTS)


def _crc_table() -> list[int]:
    """The 256 steps of crc32 by its polynomial."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def oracle() -> str:
    """The same in DuckDB's SQL over whole tables, with crc32 as a fold over a text's bytes."""
    table = "[" + ", ".join(f"{x}::BIGINT" for x in _crc_table()) + "]"
    code = lambda branch, name: f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(concat('{branch}:', doc_id, ':', {name}), ''), lambda x: ascii(x)::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 7"
    both = lambda f: f("L") + " UNION ALL " + f("R")
    codes = both(lambda b: f"SELECT '{b}' AS br, doc_id, {code(b, repr('row'))} AS rc, {code(b, repr('lang'))} AS lc, {code(b, repr('source'))} AS sc FROM d, crc")
    lines = both(lambda b: f"SELECT '{b}' AS br, doc_id, line, text, {code(b, 'line')} AS c FROM li, crc")
    edit = lambda c, v: f"CASE {c} WHEN 0 THEN '' WHEN 1 THEN {v} || '!' WHEN 2 THEN {v} || '?' ELSE {v} END"
    pick = lambda v: f"CASE WHEN {v}r <> {v} THEN {v}r ELSE {v}l END"
    clean = lambda v: f"(({v}l <> {v} OR {v}r <> {v}) AND ({v}l = {v} OR {v}r = {v} OR {v}l = {v}r))::INT"
    fight = lambda v: f"({v}l <> {v} AND {v}r <> {v} AND {v}l <> {v}r)::INT"
    return f"""
WITH crc AS MATERIALIZED (SELECT {table} AS t),
d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
li AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM d),
rows AS ({codes}), lines AS ({lines}),
w AS (
  SELECT d.*, l.rc AS rl, r.rc AS rr, {edit("l.lc", "lang")} AS langl, {edit("r.lc", "lang")} AS langr, {edit("l.sc", "source")} AS sourcel, {edit("r.sc", "source")} AS sourcer
  FROM d JOIN rows l ON l.doc_id = d.doc_id AND l.br = 'L' JOIN rows r ON r.doc_id = d.doc_id AND r.br = 'R'
),
m AS (SELECT l.doc_id, l.line, l.text, CASE WHEN w.rl = 0 THEN 5 ELSE l.c END AS a, CASE WHEN w.rr = 0 THEN 5 ELSE r.c END AS b FROM lines l JOIN lines r ON l.doc_id = r.doc_id AND l.line = r.line AND l.br = 'L' AND r.br = 'R' JOIN w ON w.doc_id = l.doc_id),
s AS (SELECT *, CASE WHEN b <= 2 THEN b WHEN a <= 2 THEN a END AS e, CASE WHEN b IN (3, 4) THEN b WHEN a IN (3, 4) THEN a END AS g FROM m),
x AS (
  SELECT doc_id, string_agg(CASE WHEN e = 0 THEN '' ELSE text || CASE e WHEN 1 THEN '!' WHEN 2 THEN '?' ELSE '' END || CASE WHEN g IS NOT NULL THEN chr(10) ELSE '' END END || CASE g WHEN 3 THEN '!' WHEN 4 THEN '?' ELSE '' END, chr(10) ORDER BY line) FILTER (e IS DISTINCT FROM 0 OR g IS NOT NULL) AS merged,
         sum(((a <= 2 OR b <= 2) AND (a > 2 OR b > 2 OR a = b))::INT + ((a IN (3, 4) OR b IN (3, 4)) AND (a NOT IN (3, 4) OR b NOT IN (3, 4) OR a = b))::INT) AS clean,
         sum((a IN (1, 2) AND b IN (1, 2) AND a <> b)::INT) AS ee, sum((a <= 2 AND b <= 2 AND (a = 0) <> (b = 0))::INT) AS ed, sum((a IN (3, 4) AND b IN (3, 4) AND a <> b)::INT) AS ii,
         bool_or(a <= 4) AS la, bool_or(b <= 4) AS ra
  FROM s GROUP BY doc_id
),
f AS (SELECT *, (la OR langl <> lang OR sourcel <> source) AS changed_l, (ra OR langr <> lang OR sourcer <> source) AS changed_r, rl <> 0 AND rr <> 0 AS kept FROM w JOIN x USING (doc_id)),
g AS (SELECT *, kept OR (rr <> 0 AND changed_r) AS lives, (rl = 0 AND rr <> 0 AND changed_r) OR (rr = 0 AND rl <> 0 AND changed_l) AS fought FROM f)
SELECT doc_id, CASE WHEN kept THEN {pick("lang")} WHEN lives THEN langr END AS lang, CASE WHEN kept THEN {pick("source")} WHEN lives THEN sourcer END AS source,
       CASE WHEN lives THEN sha256(coalesce(merged, '')) END AS text_sha256,
       CAST(CASE WHEN kept THEN clean + {clean("lang")} + {clean("source")} ELSE (NOT fought)::INT END AS BIGINT) AS n_clean,
       CAST(CASE WHEN kept THEN ee + {fight("lang")} + {fight("source")} ELSE 0 END AS BIGINT) AS n_edit_edit,
       CAST(CASE WHEN kept THEN ed ELSE fought::INT END AS BIGINT) AS n_edit_delete,
       CAST(CASE WHEN kept THEN ii ELSE 0 END AS BIGINT) AS n_insert_insert
FROM g
UNION ALL
SELECT -1 - doc_id, lang, source, sha256(CASE WHEN CASE WHEN rr IN (3, 4) THEN rr ELSE rl END = 3 THEN '!' ELSE '?' END), (rl NOT IN (3, 4) OR rr NOT IN (3, 4) OR rl = rr)::INT::BIGINT, 0::BIGINT, 0::BIGINT, (rl IN (3, 4) AND rr IN (3, 4) AND rl <> rr)::INT::BIGINT
FROM w WHERE rl IN (3, 4) OR rr IN (3, 4)"""

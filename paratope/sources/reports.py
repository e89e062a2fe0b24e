"""Germline-alignment reports (outfmt 7), restriction sites, primers, motif files, matrices and fixed-width structures."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paratope.functions.sequences import IUPAC, iupac_regex, residue_letter

STRINGS = ["queryid", "vgene", "dgene", "jgene", "chain", "strand", "stopcodon", "v_j_frame"]
DOUBLES = ["identity", "bitscore"]
INTS = ["alignlen", "vqstart", "vstart", "vmismatches", "vgaps", "dqstart", "dqend", "dstart", "dmismatches", "dgaps", "jqstart", "jqend", "jstart", "jend", "jmismatches", "jgaps"]
INTS += [f"{r}_{x}" for r in ("fr1", "cdr1", "fr2", "cdr2", "fr3g", "cdr3g") for x in ("start", "end", "mismatches", "gaps") if (r, x) not in (("fr3g", "start"),)]
INTS += ["fr3_start", "fr3_end", "cdr3_start", "cdr3_end", "fr4_start", "fr4_end"]
ANNOTATION = T.StructType([*(T.StructField(c, T.StringType()) for c in STRINGS), *(T.StructField(c, T.DoubleType()) for c in DOUBLES), *(T.StructField(c, T.IntegerType()) for c in INTS), T.StructField("unmapped", T.BooleanType())])
# Names of alignment-summary rows.
SUMMARY = {"FR1": "fr1", "FR1-IMGT": "fr1", "CDR1": "cdr1", "CDR1-IMGT": "cdr1", "FR2": "fr2", "FR2-IMGT": "fr2", "CDR2": "cdr2", "CDR2-IMGT": "cdr2", "FR3": "fr3g", "FR3-IMGT": "fr3g", "CDR3": "cdr3g", "CDR3-IMGT (germline)": "cdr3g", "CDR3 (V gene only)": "cdr3g"}


def _number(text: str) -> int | None:
    try:
        return int(text)
    except ValueError:
        return None


def parse_record(text: str) -> dict:
    """One query's block as a row; unmapped if a table is missing, there are no hits, or the first hit isn't a V gene."""
    row: dict = dict.fromkeys([f.name for f in ANNOTATION])
    row["unmapped"] = True
    section, hits = None, []
    for line in text.splitlines():
        if line.startswith("# Query:"):
            row["queryid"] = (line[8:].split() or [None])[0]
        elif "rearrangement summary" in line:
            section = "rearrangement"
        elif "sub-region sequence details" in line.lower():
            section = "cdr3"
        elif line.startswith("# Alignment summary"):
            section = "summary"
        elif line.startswith("# Fields"):
            section = "hits"
        elif line.startswith("#") or not line.strip():
            continue
        else:
            f = line.split("\t")
            if section == "rearrangement":
                first = lambda x: None if x in ("N/A", "") else x.split(",")[0]
                d = len(f) == 8
                row["vgene"], row["dgene"], row["jgene"] = first(f[0]), first(f[1]) if d else None, first(f[1 + d])
                row["chain"], row["stopcodon"], row["v_j_frame"] = f[2 + d], f[3 + d], f[4 + d]
                row["strand"] = "forward" if f[-1].strip() == "+" else "reversed"
                section = "seen"
            elif section == "cdr3" and f[0].startswith("CDR3") and len(f) >= 2:
                numbers = [n for n in map(_number, f[1:]) if n is not None]
                if len(numbers) >= 2:
                    row["cdr3_start"], row["cdr3_end"] = numbers[-2:]
                    row["fr3_end"] = numbers[-2] - 1
            elif section == "summary" and f[0] in SUMMARY and len(f) >= 7:
                r = SUMMARY[f[0]]
                row["fr3_start" if r == "fr3g" else f"{r}_start"], row[f"{r}_end"], row[f"{r}_mismatches"], row[f"{r}_gaps"] = map(_number, (f[1], f[2], f[5], f[6]))
            elif section == "hits":
                hits.append(f)
    if row["fr3_end"] is None:
        row["fr3_end"] = row["fr3g_end"]
    summary = any(row[f"{r}_start"] is not None for r in ("fr1", "cdr1", "fr2", "cdr2", "fr3"))
    if row["vgene"] is None or not summary or not hits or hits[0][0] != "V":
        return row
    # columns: kind, query, subject, identity, length, mismatches, gap openings, gaps, q. start, q. end, s. start, s. end, evalue, bits
    for kind in "VDJ":
        h = next((h for h in hits if h[0] == kind and len(h) >= 14), None)
        if h is None:
            continue
        if kind == "V":
            row["identity"], row["bitscore"] = float(h[3]), float(h[13])
            row["alignlen"], row["vmismatches"], row["vgaps"], row["vqstart"], row["vstart"] = (_number(h[i]) for i in (4, 5, 7, 8, 10))
        elif kind == "D":
            row["dmismatches"], row["dgaps"], row["dqstart"], row["dqend"], row["dstart"] = (_number(h[i]) for i in (5, 7, 8, 9, 10))
        else:
            row["jmismatches"], row["jgaps"], row["jqstart"], row["jqend"], row["jstart"], row["jend"] = (_number(h[i]) for i in (5, 7, 8, 9, 10, 11))
    row["unmapped"] = False
    return row


def read_annotations(spark: SparkSession, path: str, mark: str = "# IGBLASTN") -> DataFrame:
    """Rows of alignment reports; ``unmapped`` tells those without an annotation. Blocks are cut at ``mark``, so a report is split
    among tasks as any text is."""

    def run(frames):
        for f in frames:
            yield type(f)([parse_record(x) for x in f["value"]], columns=[c.name for c in ANNOTATION]).astype({c: "Int32" for c in INTS})

    return spark.read.text(path, lineSep=mark).where("value LIKE '%# Query:%'").mapInPandas(run, ANNOTATION)


def read_sites(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(enzyme, site) of a file of a few lines, ``#`` for comments; of enzymes named twice the last counts."""
    out: dict[str, str] = {}
    for r in _few(spark.read.text(path), 100_000):
        parts = r.value.split("#")[0].split()
        if len(parts) == 2:
            out[parts[0]] = parts[1].upper()
    return list(out.items())


def site_regexes(sites: list[tuple[str, str]]) -> dict[str, str]:
    return {e: iupac_regex(s) for e, s in sites}


def _few(df: DataFrame, most: int) -> list:
    """All rows of a small file; more than ``most`` are an error, none is left out."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return rows


def read_primers(reads: DataFrame) -> list[tuple[str, str, int]]:
    """(id, sequence, best score) of a primer file, in upper case, from its records; a match of a valid code scores 5."""
    found = [(r.read_id, r.seq.upper()) for r in _few(reads, 10_000)]
    if len({len(s) for _, s in found}) > 1:
        warnings.warn("the primers differ in length", stacklevel=2)
    return [(n, s, 5 * sum(c in IUPAC for c in s)) for n, s in found]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id) of a plain list, one a line, without ``#`` comments."""
    return spark.read.text(path).select(F.trim(F.split("value", "#")[0]).alias("id")).where("id <> ''")


def read_matrix(spark: SparkSession, path: str, missing: float = 0.9999) -> DataFrame:
    """(experiment, probe, value) of a csv whose first column names probes; missing and NaN values become ``missing``."""
    wide = spark.read.csv(path, header=True)
    probe, *others = wide.columns
    value = F.expr("try_cast(value AS double)")
    rows = wide.unpivot([probe], others, "experiment", "value")
    return rows.select(F.trim("experiment").alias("experiment"), F.col(probe).alias("probe"), F.coalesce(F.when(~F.isnan(value), value), F.lit(missing)).alias("value"))


def read_columns(spark: SparkSession, path: str) -> DataFrame:
    """(column, value) of a csv of lists, blanks left out."""
    wide = spark.read.csv(path, header=True)
    return wide.unpivot([], wide.columns, "column", "value").where("trim(coalesce(value, '')) <> ''")


def read_background(spark: SparkSession, path: str) -> DataFrame:
    """(kmer, freq) of a file of two columns."""
    p = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where("value NOT LIKE '#%'").select(F.upper(p[0]).alias("kmer"), F.expr("try_cast(try_element_at(split(trim(value), '\\\\s+'), 2) AS double)").alias("freq")).where("freq IS NOT NULL")


def read_motifs(spark: SparkSession, path: str) -> DataFrame:
    """(source, number, width, ratios, metrics) of motif files: a line ``Log-odds matrix for Motif N``, rows ``#A v v ...`` of each
    base, and ``key: value`` pairs until the next matrix."""

    def run(frames):
        for f in frames:
            rows = []
            for source, text in zip(f["source"], f["value"], strict=True):
                for block in text.split("Log-odds matrix for Motif")[1:]:
                    lines = block.splitlines()
                    number = _number((lines[0].split() or ["0"])[0]) or 0
                    by: dict[str, list[float]] = {}
                    metrics = {}
                    for line in lines[1:]:
                        parts = line.split()
                        if parts and len(parts[0]) == 2 and parts[0][0] == "#" and parts[0][1] in "ACGT":
                            by[parts[0][1]] = [float(x) for x in parts[1:] if x.replace("-", "", 1).replace(".", "", 1).isdigit()]
                        elif ":" in line:
                            k, _, v = line.partition(":")
                            try:
                                metrics[k.strip()] = float(v.split()[0])
                            except (ValueError, IndexError):
                                pass
                    if len(by) == 4:
                        rows.append((source, number, len(by["A"]), [[by[b][i] for b in "ACGT"] for i in range(len(by["A"]))], metrics))
            yield type(f)(rows, columns=["source", "number", "width", "ratios", "metrics"])

    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), "value")
    return text.mapInPandas(run, "source string, number int, width int, ratios array<array<double>>, metrics map<string,double>")


def read_atoms(spark: SparkSession, path: str) -> DataFrame:
    """ATOM lines of structure files by their fixed columns."""
    cut = lambda a, b: F.trim(F.substring("value", a, b - a + 1))
    num = lambda a, b, t: F.expr(f"try_cast(trim(substring(value, {a}, {b - a + 1})) AS {t})")
    return spark.read.text(path).where("value LIKE 'ATOM%'").select(num(7, 11, "int").alias("serial"), cut(13, 16).alias("name"), cut(18, 20).alias("residue"), cut(22, 22).alias("chain"), num(23, 26, "int").alias("number"), num(31, 38, "double").alias("x"), num(39, 46, "double").alias("y"), num(47, 54, "double").alias("z"))


def chain_sequence(atoms: DataFrame) -> DataFrame:
    """(chain, seq) from the alpha carbons; numbers without a residue are dots."""
    ca = atoms.where("name = 'CA'").groupBy("chain", "number").agg(F.min(residue_letter(F.col("residue"))).alias("letter"))
    ends = ca.groupBy("chain").agg(F.min("number").alias("lo"), F.max("number").alias("hi")).select("chain", F.explode(F.sequence("lo", "hi")).alias("number"))
    full = ends.join(ca, ["chain", "number"], "left").select("chain", "number", F.coalesce("letter", F.lit(".")).alias("letter"))
    return full.groupBy("chain").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "letter"))), lambda x: x["letter"]), "").alias("seq"))


def extract_ranges(text: str, n: int = 1) -> tuple[float, float]:
    """Bounds ``a-b``, or ``a`` for [a, infinity); a must be less than b."""
    lo, _, hi = text.partition("-")
    a, b = float(lo), float(hi) if hi else math.inf
    if a >= b:
        raise ValueError(f"{text}: the first number must be less than the second")
    return a, b

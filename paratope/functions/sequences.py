"""Column functions on DNA, protein and gene-name strings. All but translation stay inside the JVM."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# IUPAC nucleotide codes and the bases they stand for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
# Complements, with all codes and with the six codes that the motif routines know.
COMPLEMENT = ("ACGTRYKMSWBDHVNacgtrykmswbdhvn", "TGCAYRMKSWVHDBNtgcayrmkswvhdbn")
MOTIF_COMPLEMENT = ("ACGTWSKMYRNacgtwskmyrn", "TGCAWSMKRYNtgcawsmkryn")
# The standard genetic code, codons in TCAG order.
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: AMINO[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}
# Ambiguous amino-acid codes.
AMINO_CODES = {"B": "DN", "Z": "EQ", "J": "IL", "X": "ACDEFGHIKLMNPQRSTVWY"}
# Three-letter residue names.
RESIDUES = {"ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I", "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V"}


def reverse_complement(seq: Column, table: tuple[str, str] = COMPLEMENT) -> Column:
    return F.reverse(F.translate(seq, *table))


def read_ends(reads: DataFrame, size: Column, tail: bool = False) -> DataFrame:
    """(read_id, reversed, seq): for either strand the letters of a read, as it was read, that hold the first ``size`` letters in the
    strand's direction, or with ``tail`` the last ones: two rows a read. The reverse complement of a reversed row is its strand's."""
    parts = [F.struct(F.lit(r).alias("reversed"), (F.right if r != tail else F.left)(F.col("seq"), size).alias("seq")) for r in (False, True)]
    return reads.select("read_id", F.inline(F.array(*parts)))


_CODON = np.full(256, 64, dtype=np.int64)
for _i, _c in enumerate("TCAG"):
    _CODON[[ord(_c), ord(_c.lower())]] = _i
_RESIDUE = np.frombuffer((AMINO + "X").encode(), np.uint8)


def codons_translated(column: pa.Array) -> pa.Array:
    """``translate_dna`` of an Arrow array, all rows together."""
    column = column.cast(pa.large_string())
    null = np.asarray(column.is_null())
    column = column.fill_null("")
    off, data = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1], column.buffers()[2]
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(off) and (text[off[0] : off[-1]] > 127).any():  # letters of several bytes: one each
        return codons_translated(pa.array([None if n else x.encode("ascii", "replace").decode() for x, n in zip(column.to_pylist(), null, strict=True)], pa.large_string()))
    many = np.diff(off) // 3
    ends = np.concatenate([[0], np.cumsum(many)])
    at = 3 * (np.arange(ends[-1]) - np.repeat(ends[:-1], many)) + np.repeat(off[:-1], many)
    a, b, c = (_CODON[text[at + k]] for k in range(3))
    out = _RESIDUE[np.minimum(16 * a + 4 * b + c + 64 * ((b > 3) | (c > 3)), 64)]
    made = pa.LargeStringArray.from_buffers(len(many), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))
    return pc.if_else(pa.array(null), pa.scalar(None, pa.large_string()), made).cast(pa.string())


def translate_dna(seq: Column) -> Column:
    """Protein of the first frame; trailing bases are dropped, stops are ``*`` and codons with other letters ``X``.

    Codons are looked up for a batch of rows at once, in place of a lambda a codon.
    """
    return F.arrow_udf(codons_translated, StringType())(seq)


def iupac_regex(text: str) -> str:
    """A site's IUPAC codes as a regular expression; N matches anything, letters that aren't codes stay."""
    out = []
    for c in text.upper():
        bases = IUPAC.get(c, c)
        out.append("." if c == "N" else f"[{bases}]" if len(bases) > 1 else c if c == "U" else bases)
    return "".join(out)


def ambiguous_regex(text: str) -> str:
    """IUPAC codes as a regular expression in which a code also matches itself, for probes that hold codes."""
    return "".join(f"[{IUPAC[c]}{c}]" if len(IUPAC.get(c, c)) > 1 else c for c in text.upper())


def iupac_regex_column(text: Column) -> Column:
    """``iupac_regex`` of a column."""
    codes = F.create_map(*(F.lit(x) for c in IUPAC for x in (c, iupac_regex(c))))
    return F.array_join(F.transform(F.split(F.upper(text), "(?!^)"), lambda c: F.coalesce(F.try_element_at(codes, c), c)), "")


def matches_codes(seq: Column, codes: Column, table: dict[str, str]) -> Column:
    """Whether every letter of ``seq`` is one of those that the code at its place stands for; lengths must be equal."""
    allowed = F.create_map(*(F.lit(x) for c, s in table.items() for x in (c, s)))
    pairs = F.arrays_zip(F.split(F.upper(seq), "").alias("a"), F.split(F.upper(codes), "").alias("b"))
    fits = F.forall(pairs, lambda p: F.contains(F.coalesce(F.try_element_at(allowed, p[F.lit("b")]), p[F.lit("b")]), p[F.lit("a")]))
    return (F.length(seq) == F.length(codes)) & fits


def gene(name: Column) -> Column:
    """A gene without its allele: the text before ``*``."""
    return F.split(name, "[*]")[0]


def family(name: Column, strip_d: bool = True) -> Column:
    """A gene's family: the text before ``-``, then before ``/``; for counts, trailing D's go as well."""
    stem = F.split(F.split(gene(name), "-")[0], "/")[0]
    return F.rtrim(stem, F.lit("D")) if strip_d else stem


def slice_read(seq: Column, vqstart: Column, vstart: Column, fr4_end: Column) -> Column:
    """The read from where its V gene would begin to the end of FR4, or to its own end if that is missing."""
    start = F.greatest(vqstart - vstart, F.lit(0))
    return F.substring(seq, start + 1, F.greatest(F.coalesce(fr4_end, F.length(seq)) - start, F.lit(0)))


def protein_fragment(protein: Column, start: Column, end: Column, offset: Column, trim_at_stop: bool = False) -> Column:
    """Residues of a 1-based nucleotide range of a read that was translated from ``offset``.

    A missing bound, or a range of under two bases, gives the empty text; -1 leaves that side open.
    """
    s = F.when(start == -1, F.lit(0)).otherwise(F.greatest(F.floor((start - offset - 1) / 3), F.lit(0))).cast("int")
    e = F.when(end == -1, F.length(protein)).otherwise(F.floor((end - offset) / 3)).cast("int")
    piece = F.substring(protein, s + 1, F.greatest(e - s, F.lit(0)))
    if trim_at_stop:
        piece = F.regexp_extract(piece, r"^[^*]*\*?", 0)
    missing = start.isNull() | end.isNull() | ((start != -1) & (end != -1) & (end - start < 1))
    return F.when(missing, F.lit("")).otherwise(piece)


def kmers(seq: Column, k: int, block: int = 128) -> Column:
    """All runs of k letters of a text, in order. The text is first cut, in one pass, into blocks that overlap by k - 1 letters, so
    that no run is looked for from the text's front."""
    blocks = F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{1,{block + k - 1}}})).{{1,{block}}}"), 1)
    inner = lambda b: F.when(F.length(b) >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.length(b) - k + 1, F.lit(1))), lambda i: F.substring(b, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(blocks, inner))


def canonical(kmer: Column) -> Column:
    """The lesser of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer, MOTIF_COMPLEMENT))


def identical_places(a: Column, b: Column) -> Column:
    """How many places of two texts of one length hold the same letter."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda t, x: t + x)


def fixed_width(seq: Column, width: int = 70) -> Column:
    """A sequence in lines of ``width`` letters."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")


def strip_n(seq: Column) -> Column:
    """A sequence without N's at its ends."""
    return F.regexp_replace(seq, "^N+|N+$", "")


def plain_sequences(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows without N's at the ends of their sequences; those that hold other ambiguity codes, or an N further in, are dropped."""
    return df.withColumn(seq, strip_n(F.col(seq))).where(~F.upper(seq).rlike("[NRYKMSWBDHV]"))


def residue_letter(name: Column) -> Column:
    code = F.create_map(*(F.lit(x) for pair in RESIDUES.items() for x in pair))
    return F.try_element_at(code, F.upper(name))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)

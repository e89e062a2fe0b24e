"""Refinement of annotations: reading frame from the V gene's start, FR4 and CDR3 bounds, regions, and checks of the frame.

Column expressions throughout, but for the search of the FR4 consensus and of 3' sequences, pandas UDFs on short texts. A row whose
FR4 end can't be told, or whose regions don't follow one another in the protein, keeps its regions null and its counters as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paratope.functions.align import ALIGNED, aligned_pairs, no_gap_pays, path_behind, primer_matcher
from paratope.functions.sequences import protein_fragment, reverse_complement, translate_dna
from paratope.operators.productivity import REGIONS, mark_filtered
from paratope.plans.shared import written

# FR4 consensus of each chain, protein and DNA.
FR4_PROTEIN = {"VH": "WGQGTXVTVSS", "VK": "FGXGTKLEIK", "VL": "FGXGTKLTVL"}
FR4_DNA = {"VH": "TGGGGCCAGGGCACCNNNGTGACCGTGAGCAGC", "VK": "TTTGGCCAGGGGACCAAGCTGGAGATCAAA", "VL": "TTCGGCGGAGGGACCAAGCTGACCGTCCTA"}
# The names of the flags and what they tell.
FLAGS = {
    "fr1NotAtBegin": "FR1 doesn't start where the query does",
    "endsWithStopCodon": "a region holds a stop codon",
    "updatedStopCodon": "the stop codon was missed before",
    "updatedInFrame": "the frame was corrected",
    "updatedInFrameNA": "the frame was undefined",
    "updatedInFrameConc": "query and V gene start don't agree",
    "updatedInFrameNo3or4": "no CDR3 or FR4",
    "updatedInFrame3x": "the length isn't a multiple of three",
    "updatedInFrameIndel": "a framework or CDR has indels that shift the frame",
    "CDR3dna": "CDR3 was found by the DNA consensus",
    "partitioning": "the regions don't follow one another in the protein",
    "FR4PredictedError": "no FR4 end, as its consensus wasn't found",
    "FR4cutEarly": "a 3' sequence matches before the J gene's end",
    "FR4Endless": "no 3' sequence matches",
    "fr4NotAsExpected": "FR4 doesn't begin as its consensus",
    "noFR4": "no FR4",
    "filterFRLength": "a framework's length isn't that of most reads of the gene",
}
GAPPED = ("fr1", "fr2", "fr3g", "cdr1", "cdr2")


def settled(rows: DataFrame) -> DataFrame:
    """The same rows behind a generator, so that what their columns cost is paid once and not again for every use of them."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def by_chain(table: dict[str, str], chain: Column) -> Column:
    return F.when(chain == "VK", table["VK"]).when(chain == "VL", table["VL"]).otherwise(table["VH"])


def chain_of(given: str) -> Column:
    """The row's chain if it is known, else what the run was told (hv, kv, lv, or klv, which the V gene's name decides)."""
    told = F.when(F.col("vgene").contains("K"), "VK").otherwise("VL") if given == "klv" else F.lit(given[::-1].upper())
    return F.when(F.col("chain").isin("VH", "VK", "VL"), F.col("chain")).otherwise(told)


def flagged(rows: DataFrame, *flags: tuple[str, Column]) -> DataFrame:
    return rows.withColumn("flags", F.concat("flags", F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), n) for n, c in flags)))))


def reading(rows: DataFrame, chain: str = "hv", qstart: int = -1, trim5: int = 0, trim3: int = 0) -> DataFrame:
    """Adds chain, read (strand-normalised and trimmed), offset, protein and flags; sets fr1_start."""
    seq = F.when(F.col("strand") == "reversed", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    read = F.substring(seq, F.lit(trim5 + 1), F.greatest(F.length(seq) - trim5 - trim3, F.lit(0)))
    offset = F.lit(qstart) if qstart > -1 else F.greatest(F.col("vqstart") - F.col("vstart"), F.lit(0))
    known = chain_of(chain) if "chain" in rows.columns else F.lit(chain[::-1].upper())
    out = settled(rows.withColumn("chain", known).withColumn("read", read).withColumn("offset", offset.cast("int")))
    out = settled(out.withColumn("protein", translate_dna(F.expr("substring(read, offset + 1)"))))
    out = flagged(out.withColumn("flags", F.array().cast("array<string>")), ("fr1NotAtBegin", ~F.col("vqstart").eqNullSafe(F.col("fr1_start"))))
    return out.withColumn("fr1_start", F.col("offset") + 1)


def _in_protein() -> Column:
    return F.coalesce(F.col("__p.start").isNotNull() & ~F.col("__p.gapped") & (F.col("__p.end") > F.col("__p.start")), F.lit(False))


def _bounded(rows: DataFrame) -> DataFrame:
    """Bounds of CDR3 and FR4 from the consensus's places ``__p`` in the protein and ``__d`` in the DNA behind FR3."""
    rows = rows if "jqend" in rows.columns else rows.withColumn("jqend", F.lit(None).cast("int"))
    ok_p = _in_protein()
    ok_d = F.coalesce(~ok_p & F.col("__d.start").isNotNull() & (F.col("__d.end") > F.col("__d.start")), F.lit(False))
    start = F.when(ok_p, (F.col("__p.start") - 1) * 3 + F.col("fr3_end") + 1).when(ok_d, F.col("__d.start") + F.col("fr3_end"))
    end = F.when(ok_p, F.col("fr3_end") + F.col("__p.end") * 3).when(ok_d, F.col("fr3_end") + F.col("__d.end"))
    out = rows.withColumns({"fr4_start": start.cast("int"), "fr4_end": end.cast("int"), "cdr3_start": F.col("fr3_end") + 1})
    return flagged(out.withColumn("cdr3_end", F.coalesce(F.col("fr4_start") - 1, F.col("jqend"))), ("CDR3dna", ok_d)).drop("__p", "__d")


def locate_fr4(rows: DataFrame, cut: bool = True, ends: list[str] | None = None) -> DataFrame:
    """Sets cdr3_start, cdr3_end, fr4_start and fr4_end, and ``broken`` where FR4's end can't be told.

    FR4 begins with its consensus behind FR3: in the protein without a gap, else in the DNA (flag CDR3dna); else CDR3 ends with the J
    gene. It ends with the consensus if reads are cut there, else with the read, or, given 3' sequences, where one of them begins:
    without a match that end isn't told, and before the J gene's end the consensus decides.
    """
    tail = F.expr("substring(protein, cast(floor((fr3_end - offset) / 3) as int) + 1)")
    dna = F.expr("substring(read, fr3_end + 1)")
    out = settled(rows.withColumn("__p", aligned_pairs(False)(tail, by_chain(FR4_PROTEIN, F.col("chain")))))
    out = _bounded(settled(out.withColumn("__d", aligned_pairs(True)(F.when(~_in_protein(), dna), by_chain(FR4_DNA, F.col("chain"))))))
    if cut:
        out = out.withColumn("broken", F.col("fr4_end").isNull())
        return settled(flagged(out, ("FR4PredictedError", F.col("broken"))))
    if not ends:
        return settled(out.withColumn("fr4_end", F.length("read")).withColumn("broken", F.lit(False)))
    match = primer_matcher([(str(i), e.upper()) for i, e in enumerate(ends)], extend5=True)
    out = settled(out.withColumn("__t", match(F.expr("substring(read, cdr3_end + 1)"))))
    missed = F.coalesce(F.col("__t.id") == "nan", F.lit(True))
    found = F.col("cdr3_end") + F.col("__t.start")
    early = ~missed & (found < F.col("jqend"))
    out = flagged(out, ("FR4Endless", missed), ("FR4cutEarly", early)).withColumn("broken", missed)
    return settled(out.withColumn("fr4_end", F.when(~missed, F.when(F.coalesce(early, F.lit(False)), F.col("fr4_end")).otherwise(found)).cast("int")).drop("__t"))


def regions(rows: DataFrame) -> DataFrame:
    """Adds the seven region texts, null for broken rows and for those whose texts don't lie one after another in the protein, and
    flags for an unexpected or missing FR4 and for stops; a stop that the annotation missed sets stopcodon."""
    out = settled(rows.withColumns({r: protein_fragment(F.col("protein"), F.col(f"{r}_start"), F.col(f"{r}_end"), F.col("offset")) for r in REGIONS}))
    apart = ~F.col("broken") & ~F.contains(F.col("protein"), F.concat(*REGIONS))
    out = settled(flagged(out, ("partitioning", apart)).withColumn("broken", F.col("broken") | F.coalesce(apart, F.lit(True))))
    out = out.withColumns({r: F.when(~F.col("broken"), F.col(r)) for r in REGIONS})
    stop = F.coalesce(F.contains(F.concat(*REGIONS), F.lit("*")), F.lit(False))
    first = F.substring(by_chain(FR4_PROTEIN, F.col("chain")), 1, 4)
    out = flagged(
        out,
        ("fr4NotAsExpected", F.substring("fr4", 1, 4) != first),
        ("noFR4", F.col("fr4") == ""),
        ("endsWithStopCodon", stop),
        ("updatedStopCodon", stop & (F.col("stopcodon") == "No")),
    )
    return out.withColumn("stopcodon", F.when(stop & (F.col("stopcodon") == "No"), "Yes").otherwise(F.col("stopcodon")))


def counters(rows: DataFrame) -> DataFrame:
    """Bases before the alignment count as FR1's and V's gaps and mismatches, and vstart and vqstart move back by the latter; so
    filters must be applied again."""
    gaps = (F.abs(F.col("vqstart") - F.col("vstart")) - F.col("offset")).cast("int")
    missed = F.col("vstart") - 1 - F.when((F.col("vstart") > F.col("vqstart")) & (gaps > 0), gaps).otherwise(0)
    gaps = F.when(~F.col("broken"), F.greatest(gaps, F.lit(0))).otherwise(0)
    missed = F.when(~F.col("broken"), F.greatest(missed, F.lit(0))).otherwise(0)
    out = settled(rows.withColumns({"__g": gaps, "__m": missed}))
    have = [c for c in ("vgaps", "fr1_gaps") if c in rows.columns], [c for c in ("vmismatches", "fr1_mismatches") if c in rows.columns]
    sums = {c: F.col(c) + F.col("__g") for c in have[0]} | {c: F.col(c) + F.col("__m") for c in have[1]}
    return out.withColumns(sums | {"vstart": F.col("vstart") - F.col("__m"), "vqstart": F.col("vqstart") - F.col("__m")}).drop("__g", "__m")


def frame_failure(columns: list[str], qstart: int = -1) -> Column:
    """The first check that a read fails, or null; checks stop at the first failure, and reads out of frame aren't checked.

    A missing number of gaps counts as a shift, but that of the germline CDR3, which is often missing.
    """
    offset = F.col("vqstart") - F.col("vstart") + 1
    conc, thirds = offset < 1, (F.col("fr4_end") - F.col("fr1_start") + 1) % 3 != 0
    if qstart > -1:
        conc = conc | ((offset - 1 - qstart) % 3 != 0)
        thirds = thirds | ((F.col("fr4_end") - qstart) % 3 != 0)
    no34 = F.col("fr4_start").isNull() | F.col("fr4_end").isNull() | F.col("cdr3_start").isNull() | F.coalesce(F.col("cdr3_start") >= F.col("cdr3_end"), F.lit(False))
    indel = F.lit(False)
    for r in GAPPED:
        if f"{r}_gaps" in columns:
            indel = indel | F.coalesce(F.col(f"{r}_gaps") % 3 != 0, F.lit(True))
    if "cdr3g_gaps" in columns:
        indel = indel | F.coalesce(F.col("cdr3g_gaps") % 3 != 0, F.lit(False))
    return (
        F.when(F.col("v_j_frame") == "Out-of-frame", F.lit(None).cast("string"))
        .when(F.col("v_j_frame").isNull() | (F.col("v_j_frame") == "N/A"), "updatedInFrameNA")
        .when(conc, "updatedInFrameConc")
        .when(no34, "updatedInFrameNo3or4")
        .when(thirds, "updatedInFrame3x")
        .when(indel, "updatedInFrameIndel")
    )


def refine(rows: DataFrame, chain: str = "hv", qstart: int = -1, trim5: int = 0, trim3: int | list[str] = 0, cut: bool = True) -> DataFrame:
    """All steps. ``trim3`` is a number of bases, or sequences that end FR4 if reads aren't cut behind it (``cut``). A failed frame
    check sets Out-of-frame. Gap and mismatch columns of regions are used where the rows have them."""
    ends = trim3 if isinstance(trim3, list) else None
    return _checked(regions(locate_fr4(reading(rows, chain, qstart, trim5, 0 if ends else trim3), cut, ends)), qstart)


def _checked(rows: DataFrame, qstart: int = -1) -> DataFrame:
    out = counters(rows)
    out = settled(out.withColumn("__f", frame_failure(out.columns, qstart)))
    out = out.withColumn("flags", F.when(F.col("__f").isNull(), F.col("flags")).otherwise(F.concat("flags", F.array("__f", F.lit("updatedInFrame")))))
    return out.withColumn("v_j_frame", F.when(F.col("__f").isNull(), F.col("v_j_frame")).otherwise("Out-of-frame")).drop("__f", "broken")


FRAMES = 3


def frames(reads: DataFrame, consensus: str, lead: int) -> DataFrame:
    """(read_id, reversed, seq, p0, p1, p2, h0, h1, h2): for either strand of a read its protein in each frame, and where the consensus
    lies in it behind ``lead`` residues."""
    reads = reads.repartition(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few files may hold all reads
    both = reads.select("read_id", "seq", F.explode(F.array(F.lit(False), F.lit(True))).alias("reversed"))
    both = settled(both.withColumn("__s", F.when(F.col("reversed"), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))))
    both = settled(both.withColumns({f"p{i}": translate_dna(F.expr(f"substring(__s, {i + 1})")) for i in range(FRAMES)}).drop("__s"))
    return both.withColumns({f"h{i}": path_behind(consensus, lead)(F.col(f"p{i}")) for i in range(FRAMES)})


def refine_reads(rows: DataFrame, reads: DataFrame, chain: str = "hv") -> DataFrame:
    """``refine`` of annotation rows that name their read, joined to ``reads`` (read_id, seq), without the columns seq and read.

    Each strand of a read is translated once a frame, and FR4's consensus is looked for there once, in place of once a row. What was
    found holds for a row if it lies behind the row's FR3 as a whole; then the protein is all that the row needs. Other rows, those
    of short reads above all, are refined with their reads.
    """
    known = chain_of(chain) if "chain" in rows.columns else F.lit(chain[::-1].upper())
    offset = F.greatest(F.col("vqstart") - F.col("vstart"), F.lit(0)).cast("int")
    behind = F.floor((F.col("fr3_end") - F.col("offset")) / 3)  # residues before the row's tail, in its own protein
    rows = written(rows.withColumn("reversed", F.coalesce(F.col("strand") == "reversed", F.lit(False))).withColumn("offset", offset), "annotation")
    places = rows.agg(F.min(behind + F.floor(F.col("offset") / FRAMES)).alias("lead")).first()
    main = "VK" if chain == "klv" else chain[::-1].upper()
    if not no_gap_pays(FR4_PROTEIN[main]):
        raise ValueError("the consensus could be aligned with gaps")
    made = written(frames(reads.select("read_id", "seq"), FR4_PROTEIN[main], max(0, places.lead or 0)), "frames")

    def of_frame(name: str) -> Column:
        part = F.col("offset") % FRAMES
        return F.when(part == 0, F.col(f"{name}0")).when(part == 1, F.col(f"{name}1")).when(part == 2, F.col(f"{name}2"))

    # The row's protein begins floor(offset / 3) residues into the frame's, its tail ``behind`` residues further on.
    skipped = F.floor(F.col("offset") / FRAMES)
    cut = (skipped + behind).cast("int")
    found = F.struct((F.greatest(F.col("__h.start"), cut + 1) - cut).alias("start"), (F.col("__h.end") - cut).alias("end"), F.lit(False).alias("gapped"))
    met = rows.join(made.withColumn("reversed", F.col("reversed")), ["read_id", "reversed"]).withColumn("__h", of_frame("h"))
    sure = F.coalesce((known == main) & (behind >= 0) & (F.col("__h.first") > cut) & (found["end"] > found["start"]), F.lit(False))
    spare = ["reversed", "__h", *(f"{x}{i}" for x in "ph" for i in range(FRAMES))]

    fast = met.where(sure).withColumn("protein", F.substring(of_frame("p"), (skipped + 1).cast("int"), F.lit(1 << 30)))
    fast = fast.withColumn("__p", found.cast(ALIGNED)).withColumn("chain", known).drop(*spare, "seq")
    fast = flagged(settled(fast.withColumn("flags", F.array().cast("array<string>"))), ("fr1NotAtBegin", ~F.col("vqstart").eqNullSafe(F.col("fr1_start"))))
    fast = _bounded(fast.withColumn("fr1_start", F.col("offset") + 1).withColumn("__d", F.lit(None).cast(ALIGNED)))
    fast = _checked(regions(settled(fast.withColumn("broken", F.lit(False)))))
    slow = refine(met.where(~sure).drop(*spare, "offset"), chain).drop("seq", "read")
    return fast.unionByName(slow)


def mark_lengths(rows: DataFrame) -> DataFrame:
    """Adds ``filtered`` and, for reads in frame whose framework lengths aren't those of most reads, the flag filterFRLength."""
    return flagged(mark_filtered(rows), ("filterFRLength", (F.col("v_j_frame") == "In-frame") & (F.col("filtered") == "Yes")))


def flag_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("cnt"))


def flag_examples(rows: DataFrame, name: str = "queryid", seed: int = 0) -> DataFrame:
    """(flag, first, last): two ids of each flag, those of least and greatest seeded hash, by an aggregate of fixed size."""
    pairs = rows.select(F.explode("flags").alias("flag"), name, F.xxhash64(F.lit(seed), name).alias("h"))
    return pairs.groupBy("flag").agg(F.min_by(name, "h").alias("first"), F.max_by(name, "h").alias("last"))

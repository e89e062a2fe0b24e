"""Output of motif-discovery programs as motifs with their scores, and the way to the motif text format."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

from paratope.operators.motifs import BASES, UNIFORM, Motif


@dataclass
class Found:
    motif: Motif
    metrics: dict[str, float]
    seqs: list[str] = field(default_factory=list)


def parse_alignace(text: str) -> list[Found]:
    """Blocks of a line ``Motif N``, sites, a line of stars and a line ``MAP Score: x``; scores over 1000 are taken for errors (0)."""
    out = []
    for block in re.split(r"(?m)^Motif\s+\d+.*$", text)[1:]:
        head, stars, rest = block.partition("\n*")
        seqs = [line.split()[0] for line in head.splitlines() if line.split()]
        score = re.search(r"MAP Score:?\s+(-?[\d.]+(?:e[+-]?\d+)?)", rest)
        if seqs and stars:
            value = float(score[1]) if score else 0.0
            out.append(Found(Motif.from_sequences(seqs), {"MAP": 0.0 if value > 1000 else value}, seqs))
    return out


def parse_mdscan(text: str) -> list[Found]:
    """Blocks that begin with ``Mtf``; a line ``Final Motif ...`` has the score as its seventh and the seeds as its ninth word, and
    lines with ``>`` end with a site."""
    out = []
    for block in re.split(r"(?m)^Mtf ", text):
        seqs = [line.split()[-1] for line in block.splitlines() if line.startswith(">")]
        final = next((line.split() for line in block.splitlines() if line.startswith("Final Motif")), None)
        if seqs:
            metrics = {"MAP": float(final[6].rstrip(";")), "seeds": float(final[8].rstrip(";"))} if final and len(final) > 8 else {}
            out.append(Found(Motif.from_sequences(seqs), metrics, seqs))
    return out


def parse_meme(text: str) -> list[Found]:
    """Motifs by their probability matrices, with E-values and sites, under the file's background frequencies."""
    lines, background, out = text.splitlines(), dict(UNIFORM), []
    evalue, seqs = float("nan"), []
    for i, line in enumerate(lines):
        words = line.split()
        if re.match(r"Background letter frequencies", line) and i + 1 < len(lines):
            pairs = lines[i + 1].split()
            background |= {b: float(x) for b, x in zip(pairs[::2], pairs[1::2], strict=False) if b in BASES}
        elif line.startswith("MOTIF") and "E-value" in line:
            evalue, seqs = float(re.search(r"E-value\s*=\s*(\S+)", line)[1]), []
        elif len(words) > 3 and words[0] == "Motif" and words[3] == "BLOCKS":
            seqs = [row.split()[-2].replace("X", "N") for row in _until(lines, i + 3, "//")]
        elif len(words) > 3 and words[0] == "Motif" and words[3] == "probability":
            rows = [[float(x) for x in row.split()[:4]] for row in _until(lines, i + 3, "-----")]
            if rows:
                out.append(Found(Motif.from_counts(np.array(rows), background, beta=1e-5), {"evalue": evalue}, list(seqs)))
    return out


def _until(lines: list[str], start: int, stop: str) -> list[str]:
    out = []
    for line in lines[start:]:
        if line.startswith(stop):
            break
        if line.strip():
            out.append(line)
    return out


PARSERS = {"alignace": parse_alignace, "mdscan": parse_mdscan, "meme": parse_meme}


def convert(text: str, program: str, by: str | None = None, least: dict[str, float] | None = None) -> list[Found]:
    """The motifs of a program's output, in order of a metric (E-values upwards, others downwards), with metrics that are still
    missing filled in."""
    found = PARSERS[program](text)
    for f in found:
        f.metrics = dict(least or {}) | f.metrics
    key = by or ("evalue" if program == "meme" else "MAP")
    return sorted(found, key=lambda f: f.metrics.get(key, 0.0) * (1 if key in ("evalue", "p") else -1))


def motifs_of(spec: str, read) -> list[tuple[str, Motif]]:
    """Motifs named on a command line: ambiguity codes with commas between, a file, or ``file:0,2`` for some of it; ``read`` gives a
    file's motifs. Pickled files aren't read."""
    name, colon, places = spec.rpartition(":")
    if colon and re.fullmatch(r"[\d,]+", places):
        every = read(name)
        return [(f"{name}:{i}", every[int(i)]) for i in places.split(",") if i]
    if re.fullmatch(r"[ACGTUWSMKRYBDHVNacgtuwsmkrybdhvn.,]+", spec):
        return [(t, Motif.from_text(t)) for t in spec.split(",") if t]
    return [(f"{spec}:{i}", m) for i, m in enumerate(read(spec))]

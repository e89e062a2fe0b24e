"""Motif candidates as multisets of words, grown and purged by their maximum a posteriori score."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from paratope.operators.motifs import BASES, Motif


def uniform(word: str) -> float:
    """log2 probability of a word of uniform bases."""
    return -2.0 * len(word)


@dataclass
class Candidate:
    """Words of one width with their copies; ``background`` gives log2 of a word's probability."""

    words: Counter = field(default_factory=Counter)
    background: Callable[[str], float] = uniform

    @property
    def motif(self) -> Motif:
        return Motif.from_sequences([w for w, n in sorted(self.words.items()) for _ in range(n)])

    def score(self, change: dict[str, int] | None = None) -> float:
        """log2(n) / width times (sum of f log2 f over places and bases, less the mean background), with words added or taken away."""
        words = Counter(self.words)
        words.update(change or {})
        n = sum(words.values())
        if n <= 0:
            return -math.inf
        width = len(next(iter(words)))
        total = 0.0
        for i in range(width):
            column = Counter()
            for w, k in words.items():
                column[w[i]] += k
            total += sum(column[b] / n * math.log2(column[b] / n) for b in BASES if column[b] > 0)
        return math.log2(n) / width * (total - sum(k * self.background(w) for w, k in words.items()) / n)

    def grow(self, counts: Iterable[tuple[str, int]], least: float = 0.0) -> list[str]:
        """Takes in all copies of each word, in the given order, one copy of which raises the score by more than ``least``."""
        taken = []
        for word, n in counts:
            if word not in self.words and (not self.words or self.score({word: 1}) > self.score() + least):
                self.words[word] += n
                taken.append(word)
        return taken

    def purge(self) -> list[str]:
        """Drops words whose loss raises the score, again and again until none does; the last kind of word stays."""
        gone: list[str] = []
        while len(self.words) > 1:
            now = self.score()
            out = [w for w, n in self.words.items() if self.score({w: -n}) > now]
            out = out[: len(self.words) - 1]
            if not out:
                break
            for w in out:
                del self.words[w]
            gone += out
        return gone


def best_words(candidate: Candidate, seqs: Iterable[str]) -> Candidate:
    """A candidate of each sequence's best place of the motif, where that scores above 0."""
    motif, found = candidate.motif, Counter()
    for s in seqs:
        match = motif.best_match(s)
        if match and match[0] > 0:
            found[match[3]] += 1
    return Candidate(found, candidate.background)

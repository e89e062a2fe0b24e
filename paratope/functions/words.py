"""Word generators for motif searches: words with few ambiguity codes, their pairs, and gapped and symmetric words."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

from paratope.functions.sequences import MOTIF_COMPLEMENT

FLIP = str.maketrans(*MOTIF_COMPLEMENT)


def reverse(word: str) -> str:
    return word.translate(FLIP)[::-1]


def words(length: int, alphabet: str = "ACGT") -> list[str]:
    return ["".join(x) for x in product(alphabet, repeat=length)]


def unique_words(length: int) -> list[str]:
    """One of each word and its reverse complement."""
    return sorted({min(w, reverse(w)) for w in words(length)})


def words_with_a_code(length: int, plain: str = "ACGT", codes: str = "SWRY") -> list[str]:
    """All words with at most one ambiguity code."""
    out = words(length, plain)
    for at in range(length):
        out += [a + c + b for a in words(at, plain) for c in codes for b in words(length - at - 1, plain)]
    return out


def pairs(length: int) -> Iterator[tuple[str, str]]:
    """(left, right) of words with at most one code each; of a joined word and its reverse complement only the first one."""
    return _fresh((left, right) for left, right in product(words_with_a_code(length), repeat=2))


def symmetric_pairs(length: int) -> Iterator[tuple[str, str]]:
    """A word followed by itself or by its reverse complement."""
    return _fresh((w, x) for w in words_with_a_code(length) for x in (w, reverse(w)))


def _fresh(found: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    seen: set[str] = set()
    for left, right in found:
        word = left + right
        if word not in seen and reverse(word) not in seen:
            seen.add(word)
            yield left, right


def gapped_words(length: int, gaps: int = 12) -> Iterator[str]:
    """Every pair with 0 to ``gaps`` - 1 N's between."""
    some = list(pairs(length))
    return (left + "N" * g + right for g in range(gaps) for left, right in some)


def dimer_words(length: int, gaps: int = 12) -> Iterator[str]:
    some = list(symmetric_pairs(length))
    return (left + "N" * g + right for g in range(gaps) for left, right in some)


def dimer_patterns(length: int, most: int = 16) -> Iterator[str]:
    """Symmetric pairs as regular expressions with a gap of a to b letters, a < ``most`` - 1 and a <= b < ``most``."""
    some = list(symmetric_pairs(length))
    return (f"{left}.{{{a},{b}}}{right}" for a in range(most - 1) for b in range(a, most) for left, right in some)


def gapped_repeats(word: str, gaps: int = 12) -> list[str]:
    """Tandem, inverted and everted repeats of a word with 0 to ``gaps`` - 1 N's between."""
    other = reverse(word)
    return [left + "N" * g + right for left, right in ((word, word), (word, other), (other, word)) for g in range(gaps)]

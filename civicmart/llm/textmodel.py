"""Words of a text, and stable integer hashes of them with a bounded cache."""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np

LETTERS = re.compile(r"[^\W\d_]+")


def _special(codes: range) -> tuple[str, str]:
    """Combining marks, and numbers that aren't digits (\\w holds "½" too), as parts of a character class."""
    kinds = {"M": [], "N": []}
    for c in map(chr, codes):
        kind = unicodedata.category(c)
        if kind[0] == "M" or kind in ("No", "Nl"):
            kinds[kind[0]].append(c)
    return tuple(re.escape("".join(kinds[k])) for k in "MN")


def _patterns(codes: range) -> tuple[re.Pattern, re.Pattern]:
    mark, number = _special(codes)
    return re.compile(f"[{mark}{number}]"), re.compile(f"(?:[^\\W\\d_{number}][{mark}]*)+")


# Classes within the basic plane are searched by table; those with characters beyond it are slow.
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_BASIC, _WIDE = _patterns(range(0x80, 0x10000)), _patterns(range(0x80, 0x20000))
TOKENS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
CACHE = 300_000


def letter_words(text: str) -> list[str]:
    """Maximal runs of letters, each with the combining marks that follow it."""
    if text.isascii():
        return LETTERS.findall(text)
    special, words = _WIDE if _ASTRAL.search(text) else _BASIC
    return words.findall(text) if special.search(text) else LETTERS.findall(text)


class WordHash(dict):
    """word -> 32-bit crc32; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


def word_hashes(words: list[str], cache: WordHash) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, so that taking them modulo a power of two is fair."""
    with np.errstate(over="ignore"):
        x = x * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))

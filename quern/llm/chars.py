"""Vectorised access to the characters of many texts at once (code points in numpy arrays)."""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np

LETTER, DIGIT, MARK, SPACE, OTHER, BREAK = 1, 2, 3, 4, 0, 5


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point: letter, decimal or other number, combining mark, white space, line break, other."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    by = {"L": LETTER, "N": DIGIT, "M": MARK}
    cat = unicodedata.category
    for lo, hi in ((0, 0x3400), (0xA000, 0xAC00), (0xD7A4, 0xD800), (0xF900, 0x12550), (0x13000, 0x13460), (0x14400, 0x16FFF), (0x1B000, 0x1FBFA)):
        out[lo:hi] = [by.get(cat(chr(c))[0], 0) for c in range(lo, hi)]
    for lo, hi in ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0xAC00, 0xD7A4), (0x17000, 0x18D00), (0x20000, 0x323B0)):  # ideographs and syllables
        out[lo:hi] = LETTER
    out[0x4DC0:0x4E00] = 0
    for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[c] = SPACE
    out[10] = BREAK
    return out


@functools.lru_cache(maxsize=1)
def folds() -> tuple[np.ndarray, dict[int, list[int]]]:
    """For every code point the one letter or digit left of it without case, accents and compatibility forms,
    or itself; 0 where nothing is left; and, for those of which several are left, all of them."""
    table = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    several: dict[int, list[int]] = {}
    for lo, hi in ((0, 0x3400), (0xA000, 0xAC00), (0xF900, 0x10000), (0x10400, 0x10500), (0x1D400, 0x1D800), (0x1F100, 0x1F200)):
        for c in range(lo, hi):
            ch = chr(c)
            cat = unicodedata.category(ch)
            if cat[0] == "M" or cat == "Cf":
                table[c] = 0
                continue
            if cat[0] not in "LNS":
                continue
            left = [x for x in unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", ch).casefold()) if unicodedata.category(x)[0] != "M"]
            if len(left) == 1:
                table[c] = ord(left[0])
            elif left:
                several[c] = [ord(x) for x in left]
    return table, several


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def slices(texts: Iterable[str], chars: int = 1_500_000) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) runs of about ``chars`` characters, so that arrays stay small whatever the batch."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        run.append(t)
        size += len(t)
        if size >= chars:
            yield first, run
            first, run, size = i + 1, [], 0
    if run:
        yield first, run

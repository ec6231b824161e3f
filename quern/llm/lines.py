"""Statistics of every line of many texts at once.

All characters of a batch are classed by table lookup; counts of lines and words are differences of running
sums, so no Python code runs per line or per word. Words are known by a 64-bit hash of their lower-case form.
"""

from __future__ import annotations

import functools
import sys

import numpy as np

from quern.llm.chars import DIGIT, LETTER, MARK, SPACE, classes, codes

_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)

#: Marks that end a sentence in the scripts at hand, with what may close behind them.
TERMINAL = ".!?…。！？।؟．"
CLOSERS = "\"'”’»)]」』）"
#: Characters that open a list item.
BULLETS = "-*•·–—»▪◦‣●○■□►➤"


@functools.lru_cache(maxsize=1)
def tables() -> dict[str, np.ndarray]:
    base = classes()
    n = sys.maxunicode + 1
    flag = lambda chars: np.isin(np.arange(n), [ord(c) for c in chars])
    low = np.arange(n, dtype=np.uint32)
    upper = np.zeros(n, bool)
    for c in range(0x41, 0x2E00):
        ch = chr(c)
        lo = ch.lower()
        if lo != ch and len(lo) == 1:
            low[c], upper[c] = ord(lo), True
    group = np.zeros(n, np.uint8)  # 1 unspaced scripts (ideographs, kana, Thai), 2 other letters without case
    for lo, hi in ((0x0E00, 0x0E80), (0x3040, 0x3400), (0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x32000)):
        group[lo:hi] = 1
    group[(base == LETTER) & (group == 0)] = 2
    odd = (base == 0) & ~flag(".,;:!?…'\"“”‘’«»()-–—。，、；：！？·।؟،「」『』（）¿¡/%´`[]&º°ª")
    return {
        "class": base,
        "low": low,
        "upper": upper,
        "unspaced": group == 1,
        "terminal": flag(TERMINAL),
        "closer": flag(CLOSERS),
        "bullet": flag(BULLETS),
        "odd": odd,
        "noise": flag("\x00�|~`^_{}\\<>=+*#@$¤¦§¬°Ã"),
    }


def _word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each stretch [start, end), independent of its place."""
    with np.errstate(over="ignore"):
        power = np.full(len(low) + 1, _P, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        inverse = np.full(len(low) + 1, _INV, np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low.astype(np.uint64) * power[:-1], dtype=np.uint64)])
        h = (run[end] - run[start]) * inverse[start]
        return (h ^ (h >> np.uint64(32))) * np.uint64(_P)


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes of single words as :class:`Lines` computes them, sorted."""
    if not words:
        return np.zeros(0, np.uint64)
    text = " ".join(words)
    c = tables()["low"][codes(text)]
    size = np.array([len(w) for w in words])
    end = np.cumsum(size + 1) - 1
    return np.unique(_word_hashes(c, end - size, end))


class Member:
    """Fast membership of 64-bit hashes: a bit table in front of a sorted array."""

    def __init__(self, hashes: np.ndarray, bits: int = 20):
        self.hashes, self.shift = np.sort(hashes), np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.hashes >> self.shift).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = self.table[(h >> self.shift).astype(np.int64)]
        at = np.nonzero(out)[0]
        if len(at):
            place = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
            out[at] = self.hashes[place] == h[at]
        return out


class Lines:
    """Lines of a list of texts. Arrays by line: ``doc``, ``no`` (from 1), ``start``, ``end`` (in ``c``) and counts.
    Arrays by word (runs of letters, digits and combining marks): ``w_start``, ``w_end``, ``w_line``, ``w_hash``."""

    def __init__(self, texts: list[str], common: Member | None = None):
        t = tables()
        self.n_docs = len(texts)
        sizes = np.array([len(x) + 1 for x in texts], np.int64)
        self.border = np.concatenate([[0], np.cumsum(sizes)])
        c = self.c = codes("\n".join(texts) + "\n" if texts else "")
        k = self.k = t["class"][c]
        stop = np.nonzero(c == 10)[0]
        self.end = stop
        self.start = np.concatenate([[0], stop[:-1] + 1])[: len(stop)]
        self.doc = np.searchsorted(self.border, self.start, "right") - 1
        first = np.searchsorted(self.start, self.border[:-1])
        self.no = np.arange(len(stop)) - first[self.doc] + 1
        self.first_line = first

        per_line = self.per_line
        space = (k == SPACE) | (c == 10)
        solid = np.nonzero(~space)[0]
        self.solid = solid
        lo, hi = np.searchsorted(solid, self.start), np.searchsorted(solid, self.end)
        self.blank = hi <= lo
        safe = lambda i: solid[np.minimum(np.maximum(i, 0), max(len(solid) - 1, 0))] if len(solid) else np.zeros(len(lo), np.int64)
        self.head, self.tail = safe(lo), safe(hi - 1)
        self.chars = np.where(self.blank, 0, self.tail - self.head + 1)
        letter = k == LETTER
        self.letters = per_line(letter)
        self.digits = per_line(k == DIGIT)
        self.uppers = per_line(t["upper"][c])
        self.unspaced = per_line(t["unspaced"][c] & letter)
        self.odd = per_line(t["odd"][c])
        self.noise = per_line(t["noise"][c])
        self.pipes = per_line(c == 0x7C)
        self.semis = per_line(c == 0x3B)
        self.tabs = per_line(c == 9)
        self.commas = per_line(c == 0x2C)
        blank3 = (c[2:] == 32) & (c[1:-1] == 32) & (c[:-2] == 32)
        blank3 = np.concatenate([blank3, [False, False]]) & ~np.concatenate([[False], blank3, [False]])
        self.wide = per_line(blank3)
        dots = (c[3:] == 46) & (c[2:-1] == 46) & (c[1:-2] == 46) & (c[:-3] == 46)
        self.leaders = per_line(np.concatenate([dots, [False] * 3])) if len(c) > 3 else np.zeros(len(stop), np.int32)

        # Last character that is no closer: does the line end with a terminal mark?
        last = self.tail.copy()
        for _ in range(3):
            last = np.where(t["closer"][c[last]] & (last > self.head), last - 1, last)
        self.ended = t["terminal"][c[last]] & ~self.blank
        self.first_char = np.where(self.blank, 0, c[self.head])
        after = np.minimum(self.head + 1, len(c) - 1)
        bullet = t["bullet"][self.first_char] & (k[after] == SPACE)
        # "12. x", "12) x", "a) x", "(a) x"
        run = self.head.copy()
        for _ in range(3):
            run = np.where((k[run] == DIGIT) & (run < self.tail), run + 1, run)
        after_run = np.minimum(run + 1, len(c) - 1)
        number = (run > self.head) & np.isin(c[run], (46, 41)) & (k[after_run] == SPACE)
        lettered = letter[self.head] & (c[after] == 41)
        self.dash_item = bullet & np.isin(self.first_char, [0x2D, 0x2013, 0x2014])
        self.em_dash = self.first_char == 0x2014
        self.marker = (bullet | number | lettered) & ~self.blank

        # White-space words, and words of letters, digits and marks.
        token = np.concatenate([[True], space[:-1]]) & ~space
        self.tokens = per_line(token)
        self.doc_tokens = np.add.reduceat(np.append(token, 0).astype(np.int64), self.border[:-1]) if self.n_docs else np.zeros(0, np.int64)
        t_start = np.nonzero(token)[0]
        t_end = np.nonzero(~space & np.append(space[1:], True))[0] + 1
        self.t_start, self.t_end = t_start, t_end
        size = t_end - t_start
        self.t_line = np.searchsorted(self.start, t_start, "right") - 1
        self.longest = np.zeros(len(stop), np.int64)
        np.maximum.at(self.longest, self.t_line, size)

        word = letter | (k == MARK) | (k == DIGIT)
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        self.w_start, self.w_end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        self.w_line = np.searchsorted(self.start, self.w_start, "right") - 1
        self.low = t["low"][c]
        self.w_hash = _word_hashes(self.low, self.w_start, self.w_end)
        n = len(stop)
        self.words = np.bincount(self.w_line, minlength=n)
        alpha = letter[self.w_start]
        cap = t["upper"][c[self.w_start]]
        self.caps = np.bincount(self.w_line, cap, n)
        self.alpha_words = np.bincount(self.w_line, alpha, n)
        self.w_common = common(self.w_hash) & alpha if common is not None else np.zeros(len(self.w_hash), bool)
        self.common = np.bincount(self.w_line, self.w_common, n)
        spaced = alpha & ~t["unspaced"][c[self.w_start]]
        self.spaced_words = np.bincount(self.w_line, spaced, n)
        self.w_alpha, self.w_cap, self.w_spaced = alpha, cap, spaced
        #: Words in lower case that are not common: rare in prose, usual in noise.
        self.strange = np.bincount(self.w_line, spaced & ~cap & ~self.w_common, n)

    def per_line(self, flag: np.ndarray) -> np.ndarray:
        # A method, not a closure kept on the object: that would be a cycle and hold all arrays until a full collection.
        run = np.concatenate([[0], np.cumsum(flag, dtype=np.int32)])
        return run[self.end] - run[self.start]

    def by_doc(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, values, self.n_docs)


def word_records(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, texts that have the word) of all words of letters, without the other counts of :class:`Lines`."""
    t = tables()
    border = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])
    c = codes("\n".join(texts) + "\n")
    k = t["class"][c]
    edge = np.diff(np.concatenate([[False], (k == LETTER) | (k == MARK) | (k == DIGIT), [False]]).astype(np.int8))
    start, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    letters = k[start] == LETTER
    start, end = start[letters], end[letters]
    h = _word_hashes(t["low"][c], start, end)
    doc = np.searchsorted(border, start, "right")
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return np.unique(h[new], return_counts=True)


def common_words(texts: list[str], share: float = 0.004) -> np.ndarray:
    """Sorted hashes of the words that occur in at least ``share`` of the texts (at least three)."""
    from quern.llm.chars import slices

    found = [word_records(run) for _, run in slices(texts)]
    if not found:
        return np.zeros(0, np.uint64)
    word, at = np.unique(np.concatenate([h for h, _ in found]), return_inverse=True)
    count = np.bincount(at, np.concatenate([n for _, n in found]), len(word))
    return word[count >= max(3, share * len(texts))]

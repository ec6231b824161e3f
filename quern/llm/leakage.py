"""Evaluation passages inside corpus documents.

Both sides are brought to letters and digits only (case folded, accents, punctuation, markup tags and line
breaks dropped; where words start and end is kept beside). A passage of ``min_words`` item words with at most
``edits`` edits shares at least ``length + 1 - q * (edits + 1)`` character q-grams with the document inside
one diagonal band (the q-gram lemma). Shared q-grams are counted in overlapping diagonal bands; bands that
meet the bound are regions, verified by a banded alignment along their diagonals, and at last by the exact
rule: at least ``min_words`` whole consecutive words of the item, equal in the document.

The q-gram index of the items is the only broadcast; items are taken in blocks of ``ITEM_BLOCK`` (one pass
over the corpus each), which bounds it whatever the number of items. The corpus is never shuffled.

Defined cases: null and empty texts and items with fewer than ``min_words`` words give no pair; repeated
documents or items give one pair per distinct ids; empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.chars import DIGIT, LETTER, classes, codes, folds, slices

MIN_WORDS = 12
Q = 12
EDITS = 1
ITEM_BLOCK = 20_000
_TAG = regex.compile(r"<[/!?|]?[A-Za-z][^<>]*>")
_BASE = 0x9E3779B97F4A7C15


def squash(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters and digits of the texts, one after the other, and for each whether a word starts at it and
    ends with it; and where each text's own ones begin."""
    table, several = folds()
    clean = [_TAG.sub(" ", t) if "<" in t else t for t in texts]
    c = codes("\n".join(clean))
    border = np.concatenate([[0], np.cumsum([len(t) + 1 for t in clean])])
    odd = np.isin(c, _codes_of_several())
    if odd.any():
        n = np.ones(len(c), np.int64)
        at = np.nonzero(odd)[0]
        n[at] = [len(several[int(x)]) for x in c[at]]
        start = np.concatenate([[0], np.cumsum(n)])
        c = np.repeat(c, n)
        for i in at:
            c[start[i] : start[i + 1]] = several[int(table[0] + c[start[i]])]
        border = start[np.minimum(border, len(start) - 1)]
    c = table[c]
    keep = c != 0
    k = classes()[c]
    word = (k == LETTER) | (k == DIGIT)
    place = np.cumsum(keep)
    at = np.nonzero(word)[0]
    gap = np.diff(place[at], prepend=-2) > 1
    ends = np.append(gap[1:], True) if len(at) else gap
    counts = np.concatenate([[0], np.cumsum(word)])
    return c[at], gap, ends, counts[np.minimum(border, len(word))]


@functools.lru_cache(maxsize=1)
def _codes_of_several() -> np.ndarray:
    return np.array(sorted(folds()[1]), np.uint32)


def grams(c: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters from each position (wrapping 64-bit polynomial, by doubling)."""
    if len(c) < q:
        return np.zeros(0, np.uint64)
    power, width = c.astype(np.uint64), 1
    acc, have = None, 0
    base, left = _BASE, q
    while left:
        if left & 1:
            if acc is None:
                acc, have = power, width
            else:
                n = len(c) - have - width + 1
                acc = acc[:n] * np.uint64(base) + power[have : have + n]
                have += width
        left >>= 1
        if left:
            n = len(power) - width
            power = power[:n] * np.uint64(base) + power[width : width + n]
            width *= 2
            base = base * base % (1 << 64)
    return acc[: len(c) - q + 1]


class ItemIndex:
    """Sorted q-gram postings of a block of items."""

    def __init__(self, items: list[tuple[int, str]], min_words: int = MIN_WORDS, q: int = Q, edits: int = EDITS):
        self.min_words, self.q, self.edits = min_words, q, edits
        self.ids, self.chars, self.word_start, self.word_end, self.shortest, self.bound = [], [], [], [], [], []
        hashes, owner, offset = [], [], []
        for item_id, text in items:
            if not text:
                continue
            c, starts, ends, _ = squash([text])
            s, e = np.nonzero(starts)[0], np.nonzero(ends)[0] + 1
            if len(s) < min_words:
                continue
            shortest = int((e[min_words - 1 :] - s[: len(s) - min_words + 1]).min())
            h = grams(c, q)
            hashes.append(h)
            owner.append(np.full(len(h), len(self.ids), np.int32))
            offset.append(np.arange(len(h), dtype=np.int32))
            self.ids.append(item_id)
            self.chars.append(c)
            self.word_start.append(s)
            self.word_end.append(e)
            self.shortest.append(shortest)
            self.bound.append(max(1, shortest + 1 - q * (edits + 1)))
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        h = cat(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash, self.owner, self.offset = h[order], cat(owner, np.int32)[order], cat(offset, np.int32)[order]
        self.bound = np.array(self.bound, np.int64)
        self.bits = 22
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.hash >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def find(self, texts: list[str], exact: bool = True) -> list[tuple[int, object, int, int, int]]:
        """(index of text, item id, first word, words, edits) of every leak in ``texts``: by the exact rule, or by
        alignment alone."""
        c, starts, ends, border = squash(texts)
        if not len(self.hash) or len(c) < self.q:
            return []
        h = grams(c, self.q)
        at = np.nonzero(self.seen[(h >> np.uint64(64 - self.bits)).astype(np.int64)])[0]
        lo = np.searchsorted(self.hash, h[at], "left")
        hi = np.searchsorted(self.hash, h[at], "right")
        some = hi > lo
        at, lo, hi = at[some], lo[some], hi[some]
        if not len(at):
            return []
        n = hi - lo
        pos = np.repeat(at, n)
        post = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item, off = self.owner[post].astype(np.int64), self.offset[post].astype(np.int64)
        doc = np.searchsorted(border, pos, "right") - 1
        inside = pos + self.q <= border[doc + 1]
        pos, item, off, doc = pos[inside], item[inside], off[inside], doc[inside]
        # Overlapping bands of diagonals: each q-gram counts in the two bands that cover its diagonal.
        width = 2 * (self.edits + 1)
        diagonal = pos - off + (1 << 40)
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        for shift in (0, width // 2):
            band = (diagonal + shift) // width
            order = np.lexsort((pos, band, item, doc))
            d, i, b = doc[order], item[order], band[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])
            first = np.nonzero(new)[0]
            size = np.diff(np.append(first, len(d)))
            for f in first[size >= self.bound[i[first]]]:
                key = (int(d[f]), int(i[f]))
                if exact and key in out:
                    continue
                lo, hi, band0 = border[key[0]], border[key[0] + 1], int(b[f]) * width - shift - (1 << 40)
                best = self._aligned(c, lo, hi, key[1], band0, width)
                if best is None or exact and not self._whole_words(c, starts, ends, lo, hi, key[1], band0, width):
                    continue
                s, e = self.word_start[key[1]], self.word_end[key[1]]
                w0, w1 = int(np.searchsorted(s, best[0], "left")), int(np.searchsorted(e, best[1], "right"))
                if w1 - w0 >= self.min_words and (key not in out or (w1 - w0, -best[2]) > (out[key][1], -out[key][2])):
                    out[key] = (w0, w1 - w0, best[2])
                elif exact:
                    out[key] = (w0, w1 - w0, best[2])
        return [(d, self.ids[i], *best) for (d, i), best in out.items()]

    def _aligned(self, c: np.ndarray, lo: int, hi: int, item: int, diagonal: int, width: int) -> tuple[int, int, int] | None:
        """(from, to, edits) of the longest stretch of the item that aligns with the text inside the band with at most
        ``edits`` edits, None where it is shorter than ``min_words`` words can be."""
        own = self.chars[item]
        band = range(diagonal, diagonal + width)
        n = len(own)
        seed, matches, longest = (0, 0, 0), {}, []
        for d in band:
            a, b = max(lo, d), min(hi, d + n)
            if b - a < self.q:
                continue
            same = np.zeros(n + 2, bool)
            same[a - d + 1 : b - d + 1] = c[a:b] == own[a - d : b - d]
            edge = np.flatnonzero(same[1:] != same[:-1])
            matches[d] = edge
            if len(edge):
                runs = edge[1::2] - edge[::2]
                k = int(runs.argmax())
                longest += sorted(runs.tolist())[-self.edits - 1 :] if len(runs) > 1 else [int(runs[0])]
                if runs[k] > seed[0]:
                    seed = (int(runs[k]), d, int(edge[2 * k]))
        # No alignment is longer than the longest equal runs with the edits between them.
        if seed[0] < self.q or sum(sorted(longest)[-self.edits - 1 :]) + self.edits < self.shortest[item]:
            return None
        _, d0, j0 = seed
        place = np.arange(n + 1)
        # For each diagonal, where the equal run of each place of the item ends and begins (the place itself if it differs).
        after, before = {}, {}
        for d, edge in matches.items():
            first, last = edge[::2], edge[1::2]
            k = np.searchsorted(first, place, "right") - 1
            inside = (k >= 0) & (place < last[np.maximum(k, 0)]) if len(first) else np.zeros(n + 1, bool)
            after[d] = np.where(inside, last[np.maximum(k, 0)] if len(first) else place, place)
            k = np.searchsorted(last, place, "left")
            inside = (k < len(last)) & (place > first[np.minimum(k, len(first) - 1)]) if len(first) else np.zeros(n + 1, bool)
            before[d] = np.where(inside, first[np.minimum(k, len(first) - 1)] if len(first) else place, place)

        def reach(table: dict, step: int, inside) -> list[int]:
            """Furthest places in the item with 0, 1, ... edits, from the seed outwards."""
            front = {d0: int(table[d0][j0])}
            out = [front[d0]]
            far = max if step > 0 else min
            for _ in range(self.edits):
                new: dict[int, int] = {}
                for d, j in front.items():
                    # a character exchanged, one of the item left out, one of the text put in
                    for d2, j2 in ((d, j + step), (d - step, j + step), (d + step, j)):
                        if d2 in table and inside(d2, j2):
                            k = int(table[d2][j2])
                            new[d2] = far(new.get(d2, k), k)
                front = new or front
                out.append(far([out[-1], *front.values()]))
            return out

        right = reach(after, 1, lambda d, j: j <= n and d + j <= hi)
        left = reach(before, -1, lambda d, j: j >= 0 and d + j >= lo)
        spans = [(left[k], right[m], k + m) for k in range(self.edits + 1) for m in range(self.edits + 1 - k)]
        best = max(spans, key=lambda s: s[1] - s[0] - self.q * s[2])  # an edit must win back q characters
        return best if best[1] - best[0] >= self.shortest[item] else None

    def _whole_words(self, c, starts, ends, lo: int, hi: int, item: int, diagonal: int, width: int) -> bool:
        """Whether an equal run of the band holds ``min_words`` whole words of the item that are whole words here too."""
        own, s, e = self.chars[item], self.word_start[item], self.word_end[item]
        for d in range(diagonal, diagonal + width):
            a, b = max(lo, d), min(hi, d + len(own))
            if b - a < self.q:
                continue
            same = np.concatenate([[False], c[a:b] == own[a - d : b - d], [False]])
            edge = np.nonzero(same[1:] != same[:-1])[0]
            x, y = edge[::2] + a, edge[1::2] + a
            run = y - x >= self.shortest[item]
            for x, y in zip(x[run], y[run]):
                w0, w1 = np.searchsorted(s, x - d, "left"), np.searchsorted(e, y - d, "right")
                while w1 - w0 >= self.min_words:
                    if not starts[d + s[w0]]:
                        w0 += 1
                    elif not ends[d + e[w1 - 1] - 1]:
                        w1 -= 1
                    else:
                        return True
        return False


#: The last block's items and index in this worker process: tasks that follow each other build none anew.
_LAST: list = [None, None, None]


def _index(block: list[tuple], min_words: int, q: int, edits: int) -> ItemIndex:
    if _LAST[0] is not block or _LAST[1] != (min_words, q, edits):
        _LAST[:] = block, (min_words, q, edits), ItemIndex(block, min_words, q, edits)
    return _LAST[2]


def _found(documents: DataFrame, items: DataFrame, min_words: int, q: int, edits: int, exact: bool) -> DataFrame:
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text").where("text is not null and text <> ''")
    own = items.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    schema = T.StructType([documents.schema["doc_id"], items.schema["item_id"], *(T.StructField(n, T.IntegerType()) for n in ("first_word", "words", "edits"))])
    item_type = to_arrow_type(items.schema["item_id"].dataType)

    def one_pass(block: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value, min_words, q, edits)
            for batch in batches:
                hits = [(first + d, *rest) for first, run in slices(batch.column(1).to_pylist()) for d, *rest in index.find(run, exact)]
                at, *rest = list(zip(*hits)) or [()] * 5
                cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(rest[0], item_type), *(pa.array(c, pa.int32()) for c in rest[1:])]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

        return docs.mapInArrow(scan, schema)

    # The driver reads the items in blocks of bounded size, one at a time.
    block, passes = [], []
    for row in own.toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == ITEM_BLOCK:
            passes.append(one_pass(block))
            block = []
    passes.append(one_pass(block))
    return reduce(DataFrame.unionByName, passes)


def leaked(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, q: int = Q, edits: int = EDITS) -> DataFrame:
    """(doc_id, item_id) of every document that contains ``min_words`` consecutive words of an item."""
    return _found(documents, items, min_words, q, edits, True).select("doc_id", "item_id").distinct()


def passages(documents: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, q: int = 10, edits: int = 2) -> DataFrame:
    """(doc_id, item_id, first_word, words, edits): the longest passage of each item in each document that aligns with
    at most ``edits`` changed, missing or added characters and covers ``min_words`` of the item's words; words count from 0."""
    rows = _found(documents, items, min_words, q, edits, False)
    best = F.max_by(F.struct("first_word", "words", "edits"), F.struct("words", -F.col("edits"), -F.col("first_word")))
    return rows.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")

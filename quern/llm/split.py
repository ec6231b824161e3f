"""Splitting oversized texts at natural boundaries, and testing stored pieces against the same rules.

The splitter is a dynamic program over boundary positions. Every position has a penalty by its kind
(paragraph, line, sentence, word, none); a piece ends at a boundary, the next one starts at least ``overlap``
characters before that end (at a word start where there is one near), and no piece is longer than ``limit``.
The program minimises the sum of the pieces' costs (:func:`piece_cost`: cut penalty and squared shortfall of length,
infinite beyond the limit). Positions inside words take part only where nothing better lies within reach, so that a
path always exists.

Stored pieces are tested as steps of the same program: a piece has a fault where the program gives its step an infinite
cost (too long), the penalty of a cut inside a word, or no place behind the piece before it (too little in common).

Defined cases: null, empty and blank texts, and texts within the limit, are not split (no rows from
:func:`split_texts`); an id delivered twice counts once; an empty table gives an empty result; extra columns
are ignored; ties take the later boundary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.runtime import broadcast_if_small, written

LIMIT = 1200
OVERLAP = 80
#: Penalties of cutting at a paragraph, line, sentence and word end, beside a mark, and inside a word.
PENALTY = {"paragraph": 0.0, "line": 0.05, "sentence": 0.1, "word": 0.6, "mark": 1.5, "none": 3.0}
_PARA = re.compile(r"\n[^\S\n]*\n\s*")
_LINE = re.compile(r"\n")
_SENT = re.compile(r"(?:[.!?…]+[\"'»”’)\]]*(?=\s)|[。！？]+[」』”’）]*|[।؟]+)")
_WORD = re.compile(r"\s+")


def boundaries(text: str) -> dict[int, float]:
    """Position -> penalty of ending a piece there (the boundary's own characters stay with the piece)."""
    best: dict[int, float] = {}
    for pattern, kind in ((_WORD, "word"), (_SENT, "sentence"), (_LINE, "line"), (_PARA, "paragraph")):
        for m in pattern.finditer(text):
            best[m.start() if kind == "word" else m.end()] = PENALTY[kind]
    best[len(text)] = 0.0
    best.pop(0, None)
    return best


def bare_penalty(before: str, after: str) -> float:
    """Penalty of cutting between two characters where no boundary lies."""
    return PENALTY["none"] if before.isalnum() and after.isalnum() else PENALTY["mark"]


def piece_cost(length, penalty, limit: int = LIMIT):
    """Cost of a piece of ``length`` characters whose end has ``penalty``: infinite beyond the limit."""
    short = 1.0 - np.minimum(length, limit) / limit
    return np.where(np.asarray(length) > limit, np.inf, short * short + penalty)


def common_end(before: str, piece: str, least: int = OVERLAP) -> bool:
    """Whether a stretch of ``least`` or more characters is both the end of ``before`` and the start of ``piece``."""
    head, at = piece[:least], -1
    if len(head) < least:
        return False
    while (at := before.find(head, at + 1)) >= 0:
        if piece.startswith(before[at:]):
            return True
    return False


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """[start, end) of each piece of ``text``; ``limit`` must exceed twice the overlap."""
    n = len(text)
    if n <= limit:
        return [(0, n)]
    marks = boundaries(text)
    best_kind = np.array(sorted(p for p, c in marks.items() if c < PENALTY["word"]), np.int64)
    words = np.array(sorted(marks), np.int64)
    starts = np.array([m.end() for m in _WORD.finditer(text)], np.int64)
    reach = (limit - 2 * overlap) // 2

    # Word ends are needed only where sentence ends are too far apart, every position only where words are.
    def fill(kept: np.ndarray, finer: np.ndarray) -> np.ndarray:
        edges = np.concatenate([[0], kept])
        wide = np.nonzero(np.diff(edges) > reach)[0]
        extra = [finer[np.searchsorted(finer, edges[i], "right") : np.searchsorted(finer, edges[i + 1], "left")] for i in wide]
        return np.unique(np.concatenate([kept, *extra])) if extra else kept

    ends = fill(best_kind if len(best_kind) and best_kind[-1] == n else np.append(best_kind, n), words)
    ends = fill(ends, np.arange(1, n + 1))
    cut = np.array([marks[p] if p in marks else bare_penalty(text[p - 1], text[p]) for p in ends.tolist()])

    # Where the piece after an end starts: the last word start that leaves the overlap, if it is near.
    target = ends - overlap
    near = np.searchsorted(starts, target, "right") - 1
    begin = np.where(near >= 0, starts[np.maximum(near, 0)] if len(starts) else 0, 0)
    begin = np.where((target - begin > overlap) | (near < 0), target, begin)
    begin = np.maximum(begin, 0)

    m = len(ends)
    cost = np.full(m + 1, np.inf)
    back = np.full(m + 1, -1, np.int64)
    cost[0] = 0.0
    begin = np.concatenate([[0], begin])
    at = np.concatenate([[0], ends])
    lo = 0
    for j in range(1, m + 1):
        while at[j] - begin[lo] > limit:
            lo += 1
        if lo == j:  # cannot happen while reach < limit - overlap; kept as a guard
            raise ValueError("no boundary within the limit")
        total = cost[lo:j] + piece_cost(at[j] - begin[lo:j], cut[j - 1] if at[j] < n else 0.0, limit)
        k = int(np.argmin(total[::-1]))
        k = len(total) - 1 - k
        cost[j] = total[k]
        back[j] = lo + k
    pieces, j = [], m
    while j > 0:
        pieces.append((int(begin[back[j]]), int(at[j])))
        j = back[j]
    return pieces[::-1]


def split_texts(df: DataFrame, id_col: str = "id", text_col: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(record_id, chunk_index, chunk_text) of every text longer than ``limit``; one set of pieces per id.

    Ids delivered twice are told apart before cutting, by their keys alone: only their texts are shuffled.
    """
    rows = df.select(F.col(id_col).alias("record_id"), F.col(text_col).alias("_text")).where(F.length("_text") > limit)
    twice = broadcast_if_small(written(rows.groupBy("record_id").count().where("count > 1").select("record_id"), "twice"))
    once = rows.where("record_id is null").unionByName(rows.where("record_id is not null").join(twice, "record_id", "left_anti"))
    rows = once.unionByName(rows.join(twice, "record_id", "left_semi").groupBy("record_id").agg(F.max("_text").alias("_text")))
    schema = T.StructType([rows.schema["record_id"], T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk_text", T.StringType())])

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = [(r, i, t[a:b]) for r, t in zip(pdf["record_id"], pdf["_text"]) for i, (a, b) in enumerate(split_text(t, limit, overlap))]
            yield pd.DataFrame(out, columns=["record_id", "chunk_index", "chunk_text"])

    return rows.mapInPandas(cut, schema)


def piece_faults(chunks: DataFrame, records: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(id, fault) of the stored pieces: oversize, mid_word, missing_before, no_overlap."""
    pieces = chunks.where("id is not null").select("id", "record_id", "table_name", "chunk_index", "chunk_text").dropDuplicates(["id"])
    cut_here = F.col("table_name").isNull() | (F.col("table_name") != "qa_dataset")
    other = pieces.where(cut_here).select("id", "record_id", "chunk_index", "chunk_text")

    # The character behind each piece, from its record's text, moved only for records that have pieces.
    wanted = chunks.where(cut_here).select(F.col("record_id").alias("_rid")).distinct()
    texts = records.select(F.col("id").alias("_rid"), F.col("text").alias("_text")).where("_text is not null and _rid is not null")
    texts = texts.join(broadcast_if_small(wanted), "_rid", "left_semi")
    joined = other.where("chunk_text <> ''").join(texts, F.col("record_id") == F.col("_rid"))
    behind = joined.where("instr(_text, chunk_text) > 0").select("id", F.expr("right(chunk_text, 1)").alias("_last"), F.expr("substring(_text, instr(_text, chunk_text) + length(chunk_text), 1)").alias("_after"))

    before = other.select(F.col("record_id").alias("_prid"), (F.col("chunk_index") + 1).alias("_pidx"), F.col("chunk_text").alias("_prev")).distinct()
    chain = other.where("chunk_index > 0").join(before, (F.col("record_id") == F.col("_prid")) & (F.col("chunk_index") == F.col("_pidx")), "left")

    # Each step of a stored cutting as the program sees it: its length, the characters around its end, the piece before.
    none, no = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    steps = [
        pieces.select("id", F.length("chunk_text").alias("size"), none.alias("last"), none.alias("after"), none.alias("prev"), none.alias("piece"), no.alias("has")),
        behind.select("id", F.lit(None).cast("int").alias("size"), F.col("_last").alias("last"), F.col("_after").alias("after"), none.alias("prev"), none.alias("piece"), no.alias("has")),
        chain.select("id", F.lit(None).cast("int").alias("size"), none.alias("last"), none.alias("after"), F.coalesce("_prev", F.lit("")).alias("prev"), F.coalesce("chunk_text", F.lit("")).alias("piece"), F.col("_pidx").isNotNull().alias("has")),
    ]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            faults = [_step_fault(*row, limit, overlap) for row in zip(*(b.column(i).to_pylist() for i in range(1, 7)))]
            keep = pa.array([i for i, f in enumerate(faults) if f], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(keep), pa.array([f for f in faults if f], pa.string())], names=["id", "fault"])

    schema = T.StructType([pieces.schema["id"], T.StructField("fault", T.StringType())])
    found = steps[0].unionByName(steps[1]).unionByName(steps[2]).mapInArrow(judge, schema).groupBy("id").agg(F.collect_set("fault").alias("_f"))
    # A piece of which several stand before it is sound if it follows one of them.
    sound = F.array(F.lit("sound"), F.lit("no_overlap"))
    return found.select("id", F.explode(F.when(F.array_contains("_f", "sound"), F.array_except("_f", sound)).otherwise(F.col("_f"))).alias("fault"))


def _step_fault(size: int | None, last: str | None, after: str | None, prev: str | None, piece: str | None, has: bool | None, limit: int, overlap: int) -> str | None:
    """What is wrong with one step; ``sound`` for a step that follows a piece as it should."""
    if size is not None:
        return "oversize" if not np.isfinite(piece_cost(size, 0.0, limit)) else None
    if last is not None:
        return "mid_word" if bare_penalty(last, after or "") == PENALTY["none"] else None
    if has is None:
        return None
    return "missing_before" if not has else "sound" if common_end(prev, piece, overlap) else "no_overlap"

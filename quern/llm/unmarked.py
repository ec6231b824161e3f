"""Sentence ends in Chinese and Japanese text that bears no marks.

A linear chain tags every place between two characters as boundary or inside. It learns from punctuated text with its
closing marks taken out: where a mark stood is a boundary. Places are described by the characters around them, hashed.

:func:`quern.llm.sentences.sentence_units` does not use it, since a heading without a mark is one unit there; it is for
text whose marks were lost. Defined cases: texts of other scripts, null and empty texts have no ends; a line break or the
end of the text ends a unit; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.chars import codes
from quern.llm.crf import ConditionalField
from quern.llm.sampling import bounded_texts

#: Closing marks of the two scripts, and what closes behind them.
MARKS, CLOSERS = "。！？｡", "」』”’）"
#: Bounds of the training sample; longer texts are cut like all others but not learned from.
TRAIN_DOCS, TRAIN_CHARS, LONG_CHARS = 2_000, 300_000, 20_000
BUCKETS = 1 << 16
#: Characters of one training sequence.
WINDOW = 200


def unspaced_share(text: str) -> float:
    """Share of ideographs and kana among the characters that are no white space."""
    c = codes("".join(text.split()))
    return float((((c >= 0x3040) & (c < 0x3100)) | ((c >= 0x3400) & (c < 0xA000))).mean()) if len(c) else 0.0


def stripped(text: str) -> tuple[str, list[int]]:
    """(text without closing marks, places where a unit ended)."""
    out: list[str] = []
    ends: list[int] = []
    size = 0
    for i, ch in enumerate(text):
        if ch in MARKS:
            if size and text[i + 1 : i + 2] not in tuple(MARKS + CLOSERS):
                ends.append(size)
            continue
        out.append(ch)
        size += 1
        if ch in CLOSERS and i and text[i - 1] in MARKS:
            ends.append(size)
    return "".join(out), sorted(set(ends))


def places(text: str) -> np.ndarray:
    """(places x features): place i lies behind character i."""
    c = np.concatenate([[1, 2], codes(text).astype(np.uint64), [3, 4, 5]]).astype(np.uint64)
    n = len(text)
    at = {k: c[2 + k : 2 + k + n] for k in range(-2, 4)}  # character at distance k of character i
    out = []
    with np.errstate(over="ignore"):
        for number, group in enumerate([(0, 1), (-1, 0), (1, 2), (-1, 0, 1), (0, 1, 2), (-2, -1, 0), (1, 2, 3)]):
            h = np.full(n, number + 1, np.uint64)
            for k in group:
                h = (h ^ at[k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out.append((h % np.uint64(BUCKETS)).astype(np.int64))
    return np.stack(out, 1)


def fit(texts: list[str]) -> ConditionalField:
    xs, ys = [], []
    for text in texts:
        if unspaced_share(text) < 0.5:
            continue
        for line in text.split("\n"):
            plain, ends = stripped(line)
            if len(ends) < 2:
                continue
            rows = places(plain)
            y = np.zeros(len(plain), np.int64)
            y[np.array(ends) - 1] = 1
            for a in range(0, len(plain), WINDOW):
                xs.append(list(rows[a : a + WINDOW]))
                ys.append(y[a : a + WINDOW].tolist())
    return ConditionalField(2, BUCKETS).fit(xs, ys, rounds=6, batch=64) if xs else ConditionalField(2, BUCKETS)


def unit_ends(texts: list[str], field: ConditionalField) -> list[list[int]]:
    """Ends of the units of each text; none for texts of other scripts."""
    out: list[list[int]] = [[] for _ in texts]
    where, xs = [], []
    for i, text in enumerate(texts):
        if text and unspaced_share(text) >= 0.5:
            at = 0
            for line in text.split("\n"):
                if line.strip():
                    where.append((i, at, len(line.rstrip())))
                    xs.append(list(places(line.rstrip())))
                at += len(line) + 1
    for (i, at, size), tags in zip(where, field.decode(xs, 64)):
        out[i] += sorted({at + int(k) + 1 for k in np.nonzero(tags)[0]} | {at + size})
    return out


def unmarked_units(df: DataFrame, field: ConditionalField | None = None, strip: bool = False) -> DataFrame:
    """(doc_id, sent_end) of the units of Chinese and Japanese texts read without marks; ``strip`` takes the texts' own
    marks out first, and ends are then places in the stripped text."""
    if field is None:
        rows = bounded_texts(df.where(F.col("text").rlike("[぀-ヿ㐀-鿿]")), "doc_id", "text", rows=TRAIN_DOCS, chars=TRAIN_CHARS, longest=LONG_CHARS)
        field = fit([r["text"] for r in rows])
    shared = df.sparkSession.sparkContext.broadcast(field)
    schema = T.StructType([df.schema["doc_id"], T.StructField("sent_end", T.IntegerType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ends = unit_ends([stripped(t)[0] for t in texts] if strip else texts, shared.value)
            at = pa.array(np.repeat(np.arange(len(texts)), [len(e) for e in ends]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([x for e in ends for x in e], pa.int32())], names=["doc_id", "sent_end"])

    rows = df.where("doc_id is not null and text is not null").where(F.col("text").rlike("[぀-ヿ㐀-鿿]")).select("doc_id", "text")
    return rows.mapInArrow(cut, schema).distinct()

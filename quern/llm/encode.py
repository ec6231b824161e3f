"""Corpus encoding with a public byte-level BPE vocabulary.

Texts up to ``long_chars`` code points are encoded in one call per text, inside one Arrow pass and without
a shuffle. A longer text is cut into leaves that are encoded in parallel tasks; the leaves' results are then
concatenated pairwise as a tree. At each join the text is scanned again from the last pre-token start on the
left that the text behind the join cannot move (the scan looks less than ``AHEAD`` characters past a pre-token's
end) until a pre-token start on the right is met (from there on both scans agree, as the scan only looks ahead). Where one pre-token runs across the join (text without any split), a window of
tokens around the join is re-encoded and grown until both of its ends form valid token pairs with the
tokens kept outside; a sequence whose adjacent pairs are all valid is the one the whole text encodes to.

Defined cases: a null text and an empty text both give an empty list; strings that look like special tokens
are ordinary text; repeated rows give repeated rows; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF_CHARS = 16_384
LONG_CHARS = LEAF_CHARS
#: Neighbours joined by one task on each level of the tree.
FAN = 8
#: Fixed value: the split pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

#: Pre-tokens that end so many characters before the end of a text stay what they are whatever follows it.
AHEAD = 3


@functools.lru_cache(maxsize=4)
def coder(vocab: str = VOCAB):
    """The encoder of a rank file, built once per Python worker."""
    import tiktoken

    with open(vocab, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_SCAN = regex.compile(PATTERN)


class Node:
    """The encoding of a stretch of text: its text, pre-token lengths (characters) and each one's ids."""

    __slots__ = ("ids", "spans", "text")

    def __init__(self, text: str, spans: list[int], ids: list[list[int]]):
        self.text, self.spans, self.ids = text, spans, ids


def leaf(text: str, vocab: str = VOCAB) -> Node:
    enc = coder(vocab)
    pieces = [m.group() for m in _SCAN.finditer(text)]
    return Node(text, [len(p) for p in pieces], [enc._encode_single_piece(p) for p in pieces])


def join_tokens(a: list[int], b: list[int], vocab: str = VOCAB) -> list[int]:
    """Ids of the one pre-token whose halves encode to ``a`` and ``b``, by windows growing around the join."""
    enc = coder(vocab)
    raw = enc.decode_single_token_bytes

    def fits(x: int, y: int) -> bool:
        return enc._encode_single_piece(raw(x) + raw(y)) == [x, y]

    k = 1
    while True:
        left, right = a[: max(0, len(a) - k)], b[k:]
        window = enc._encode_single_piece(b"".join(map(raw, a[len(left) :] + b[:k])))
        if (not left or fits(left[-1], window[0])) and (not right or fits(window[-1], right[0])):
            return left + window + right
        k *= 2


def concat(a: Node, b: Node, vocab: str = VOCAB) -> Node:
    """The encoding of ``a.text + b.text``."""
    if not a.text or not b.text:
        return b if not a.text else a
    enc = coder(vocab)
    text = a.text + b.text
    edge = len(a.text)
    last = edge - a.spans[-1]
    at, known, i = edge, {}, len(a.spans)
    while i and at > edge - AHEAD:
        i -= 1
        known[at - a.spans[i], at] = a.ids[i]
        at -= a.spans[i]
    starts, pos = {}, edge
    for j, n in enumerate(b.spans):
        starts[pos] = j
        pos += n
    spans, ids = a.spans[:i], a.ids[:i]
    first_right = edge + b.spans[0]
    for m in _SCAN.finditer(text, at):
        if m.start() in starts:
            j = starts[m.start()]
            return Node(text, spans + b.spans[j:], ids + b.ids[j:])
        spans.append(m.end() - m.start())
        if m.span() in known:
            ids.append(known[m.span()])
        elif m.span() == (last, first_right):
            ids.append(join_tokens(a.ids[-1], b.ids[0], vocab))
        else:
            ids.append(enc._encode_single_piece(m.group()))
    return Node(text, spans, ids)


def encode_long(text: str, leaf_chars: int = LEAF_CHARS, vocab: str = VOCAB) -> list[int]:
    """Ids of ``text`` by tree concatenation in this process (the brute-force twin of the Spark path)."""
    nodes = [leaf(text[i : i + leaf_chars], vocab) for i in range(0, len(text), leaf_chars)]
    return _flat(_tree(nodes, vocab))


def _tree(nodes: list[Node], vocab: str) -> Node:
    if not nodes:
        return Node("", [], [])
    while len(nodes) > 1:
        nodes = [concat(nodes[i], nodes[i + 1], vocab) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    return nodes[0]


def _flat(node: Node) -> list[int]:
    return [x for part in node.ids for x in part]


def encode_corpus(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocab: str = VOCAB,
    long_chars: int = LONG_CHARS,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """(``id_col``, ids array<int>) of every row of ``df``."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType
    long_text = F.coalesce(F.length("_text") > long_chars, F.lit(False))
    schema = T.StructType([T.StructField("_id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(vocab).encode_ordinary
        for batch in batches:
            out = [encode(t) if t else [] for t in batch.column(1).to_pylist()]
            ends = np.zeros(len(out) + 1, np.int32)
            np.cumsum([len(x) for x in out], out=ends[1:])
            flat = np.fromiter((x for part in out for x in part), np.int32, int(ends[-1]))
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["_id", "ids"])

    short = rows.where(~long_text).mapInArrow(direct, schema)

    # Repeated rows keep apart by a row number of their own.
    cut = (
        rows.where(long_text)
        .withColumn("_row", F.monotonically_increasing_id())
        .select(
            "_id",
            "_row",
            F.posexplode(F.expr(f"transform(sequence(0, int((length(_text) - 1) / {leaf_chars})), i -> substring(_text, i * {leaf_chars} + 1, {leaf_chars}))")).alias("_n", "_leaf"),
        )
        .repartition("_row", "_n")
    )
    leaves = T.StructType(cut.schema.fields + [T.StructField("_spans", T.ArrayType(T.IntegerType())), T.StructField("_ids", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def encode_leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            nodes = [leaf(t, vocab) for t in pdf["_leaf"]]
            yield pdf.assign(_spans=[n.spans for n in nodes], _ids=[n.ids for n in nodes])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        """Neighbours of one text as one node."""
        pdf = pdf.sort_values("_n")
        nodes = [Node(t, [int(x) for x in s], [[int(y) for y in x] for x in i]) for t, s, i in zip(pdf["_leaf"], pdf["_spans"], pdf["_ids"])]
        whole = _tree(nodes, vocab)
        return pd.DataFrame({"_id": [pdf["_id"].iloc[0]], "_row": [pdf["_row"].iloc[0]], "_n": [int(pdf["_n"].iloc[0]) // FAN], "_leaf": [whole.text], "_spans": [whole.spans], "_ids": [whole.ids]})

    longest = rows.where(long_text).agg(F.max(F.length("_text"))).first()[0]
    if longest is None:
        return short.select(F.col("_id").alias(id_col), "ids")
    nodes, count = cut.mapInPandas(encode_leaves, leaves), -(-longest // leaf_chars)
    # The tree, level by level: neighbours meet in tasks of their own, whatever the number of leaves of a text.
    while count > 1:
        nodes, count = nodes.groupBy("_row", F.floor(F.col("_n") / FAN).alias("_up")).applyInPandas(joined, leaves), -(-count // FAN)
    tall = nodes.select("_id", F.flatten("_ids").alias("ids"))
    return short.unionByName(tall).select(F.col("_id").alias(id_col), "ids")

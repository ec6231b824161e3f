"""Pieces of texts: by words, by tokens, by characters with overlap; rows put back together in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import WHITE


def by_words(df: DataFrame, size: int = 8_000, text: str = "text") -> DataFrame:
    """(…, chunk_index, chunk_text): runs of ``size`` words joined by one space; texts without words have none."""
    words = F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")
    rest = [c for c in df.columns if c != text]
    rows = df.select(*rest, words.alias("_w")).where(F.size("_w") > 0)
    rows = rows.select(*rest, "_w", F.explode(F.sequence(F.lit(0), F.floor((F.size("_w") - 1) / size).cast("int"))).alias("chunk_index"))
    return rows.select(*rest, "chunk_index", F.array_join(F.slice("_w", F.col("chunk_index") * size + 1, F.lit(size)), " ").alias("chunk_text"))


def by_tokens(df: DataFrame, split: Callable[[str], list[str]], size: int = 8_000, text: str = "text", key: str = "id") -> DataFrame:
    """(key, chunk_index, chunk_text): runs of ``size`` tokens. ``split`` gives the tokens, whose concatenation is the text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(k, i // size, "".join(tokens[i : i + size])) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for tokens in [split(t)] for i in range(0, len(tokens), size)]
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string())], names=[key, "chunk_index", "chunk_text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(cut, f"{key} {kind}, chunk_index int, chunk_text string")


def overlapping(text: str | Column, most: int = 160_000, size: int = 120_000, overlap: int = 10_000) -> Column:
    """The whole text where it has at most ``most`` characters, else stretches of ``size`` characters that begin
    ``size - overlap`` apart, up to the first that reaches the end; null for null."""
    text = F.col(text) if isinstance(text, str) else text
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int"))
    return F.when(F.length(text) <= most, F.array(text)).when(F.length(text) > most, F.transform(starts, lambda i: F.substring(text, i * step + 1, F.lit(size))))


#: Fixed value: the heading of a part, whose consolidation prompts rely on it.
PART_HEADING = "\n--- FRAGMENTO {n} ---\n"


def joined(df: DataFrame, keys: list[str], position: str, text: str, heading: str = PART_HEADING, end: str = "\n") -> DataFrame:
    """(keys, text): the parts that are not empty, in order, each under its heading; ``{n}`` is the position from 1."""
    before, after = heading.split("{n}")
    part = F.concat(F.lit(before), (F.col(position) + 1).cast("string"), F.lit(after), F.col(text), F.lit(end))
    rows = df.where(F.col(text) != "").select(*keys, F.struct(F.col(position).alias("p"), part.alias("t")).alias("_part"))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_part")), lambda x: x["t"]), "").alias(text))


def keyword_union(df: DataFrame, keys: list[str], keywords: str) -> DataFrame:
    """(keys, keywords): the distinct keywords of all rows, sorted."""
    return df.select(*keys, F.explode(keywords).alias("_k")).groupBy(*keys).agg(F.array_sort(F.collect_set("_k")).alias(keywords))


def batches(df: DataFrame, size: int, order: str) -> DataFrame:
    """The rows with ``batch``: numbers of runs of ``size`` rows in each partition's order, unique over partitions."""

    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in parts:
            yield b.append_column("slot", pa.array(range(n, n + b.num_rows), pa.int64()))
            n += b.num_rows

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", slot long"
    rows = df.sortWithinPartitions(order).mapInArrow(number, schema)
    return rows.withColumn("batch", F.concat_ws("-", F.spark_partition_id(), F.floor(F.col("slot") / size))).drop("slot")

"""Vectors of texts by a provider, and their way into tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import jsons, text
from quern.functions.errors import too_many_tokens  # noqa: F401 - the class of errors that halve a batch
from quern.operators import chunks
from quern.providers import halving, provider


def _too_large(error: Exception) -> bool:
    low = str(error).lower()
    return "too many tokens" in low or "split into more batches" in low or ("400" in low and "token" in low)


def embedded(rows: DataFrame, column: str = "chunk_text", name: str = "offline", batch: int = 25) -> DataFrame:
    """The rows with ``embedding``; ``batch`` texts a call, a batch that is too large is halved."""

    @F.pandas_udf("array<double>")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = provider(name)
        for texts in batches:
            out: list = []
            for i in range(0, len(texts), batch):
                part = [t or "" for t in texts[i : i + batch]]
                made = halving(own.embed, part, _too_large)
                if len(made) != len(part):
                    raise ValueError(f"{len(part)} texts gave {len(made)} vectors")
                out += made
            yield pd.Series(out, dtype=object)

    return rows.withColumn("embedding", call(text.embedder_input(column)))


def chunk_rows(records: DataFrame, table: str, name: str = "offline", size: int = 8_000) -> DataFrame:
    """Chunk rows of (id, text) records that are not blank: pieces of ``size`` tokens with their vectors."""
    some = records.where(~text.is_blank("text"))
    rows = chunks.by_tokens(some, provider(name).tokens, size)
    rows = embedded(rows, "chunk_text", name).withColumnRenamed("id", "record_id")
    return rows.select(
        F.sha2(F.concat_ws("\x1f", F.lit(table), "record_id", "chunk_index"), 256).alias("id"), "record_id", F.lit(table).alias("table_name"), "chunk_index", "chunk_text", "embedding", F.current_timestamp().alias("created_at")
    )


def metadata_text(table: str, title: str = "title", metadata: str = "metadata"):
    """What of a record's metadata is embedded: null for nothing."""
    part = lambda n: jsons.field(metadata, n)
    if table == "corpus":
        return jsons.labelled_text(Title=F.col(title), Domain=part("domain"), Topic=part("topic"), Difficulty=part("difficulty"))
    return jsons.labelled_text(Topic=part("topic"), Model=part("model_used"), Source=part("source"))

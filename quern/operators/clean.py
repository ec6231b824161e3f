"""Cleaning of raw records by a provider: admission, the call on the head of the text, recomposition, metadata."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import jsons, text
from quern.providers import provider

LEAST, HEAD = 100, 4_000


def admitted(raw: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(records long enough to be cleaned, records that only count as done); a null text is too short."""
    ok = F.coalesce(F.length("text") >= least, F.lit(False))
    return raw.where(ok), raw.where(~ok)


def cleaned(raw: DataFrame, name: str = "offline") -> DataFrame:
    """The records with ``result``: what the provider made of the first characters of the text (null for nothing)."""

    @F.pandas_udf(jsons.CLEANED)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = provider(name)
        for batch in batches:
            rows = [own.clean(t) or {} for t in batch]
            yield pd.DataFrame([{f: r.get(f) for f in jsons.CLEANED.names} for r in rows], columns=jsons.CLEANED.names).astype({"language_quality": "Int32"})

    return raw.withColumn("result", call(text.head("text", HEAD)))


def recomposed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for the cleaned table, records without a result) of :func:`cleaned`."""
    result = F.col("result")
    ok = F.coalesce(result["cleaned_text"] != "", F.lit(False))
    full = text.recompose(result["cleaned_text"], "text", HEAD)
    meta = jsons.metadata(raw_id="id", topic=result["topic"], difficulty=result["difficulty"], domain=result["domain"], language_quality=result["language_quality"], char_count=F.length(full))
    out = rows.where(ok).select(F.sha2(F.concat_ws("\x1f", F.lit("clean"), "id"), 256).alias("id"), "title", full.alias("text"), "url", "language", "extracted_at", F.lit(None).cast("array<double>").alias("embedding"), meta.alias("metadata"))
    return out, rows.where(~ok)

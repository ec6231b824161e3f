"""Question and answer rows from texts: abstracts (long texts in parts), routing, questions, answers, flattening."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text
from quern.operators import chunks
from quern.providers import provider

DONE, ASIDE = "done", "put_aside"
_ABSTRACT = "id string, part int, abstract string, keywords array<string>"
_MADE = "id string, status string, items array<struct<question: string, reasoning: string, answer: string>>"


def _abstracts(rows: DataFrame, name: str, call: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = provider(name)
        for b in batches:
            made = [getattr(own, call)(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([m.get("abstract") or "" for m in made], pa.string()), pa.array([m.get("keywords") or [] for m in made], pa.list_(pa.string()))], names=["id", "part", "abstract", "keywords"]
            )

    return rows.select("id", "part", "text").mapInArrow(run, _ABSTRACT)


def abstracts(rows: DataFrame, name: str = "offline", most: int = 160_000, size: int = 120_000, overlap: int = 10_000) -> DataFrame:
    """(id, abstract, keywords) of each text that is not blank. Long texts are read in overlapping parts, whose abstracts
    are consolidated; keywords are the union of all parts'."""
    some = rows.where(~text.is_blank("text")).select(F.col("id").cast("string").alias("id"), "text")
    short = some.where(F.length("text") <= most).withColumn("part", F.lit(0))
    parts = some.where(F.length("text") > most).select("id", F.posexplode(chunks.overlapping("text", most, size, overlap)).alias("part", "text"))
    partial = _abstracts(parts, name, "abstract")
    whole = chunks.joined(partial.withColumnRenamed("abstract", "text"), ["id"], "part", "text").withColumn("part", F.lit(0))
    final = _abstracts(whole, name, "consolidate").unionByName(partial.withColumn("abstract", F.lit("")))
    long = final.groupBy("id").agg(F.max("abstract").alias("abstract"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("keywords")))).alias("keywords"))
    return _abstracts(short, name, "abstract").select("id", "abstract", F.array_sort(F.array_distinct("keywords")).alias("keywords")).unionByName(long)


def routed(rows: DataFrame) -> DataFrame:
    """The rows with ``status``: put aside where the abstract is empty or the text useless, else done."""
    return rows.withColumn("status", F.when(F.coalesce(F.col("useless"), F.lit(False)) | F.coalesce(F.col("abstract") == "", F.lit(True)), F.lit(ASIDE)).otherwise(F.lit(DONE)))


def generated(abstract_rows: DataFrame, name: str = "offline", count: int = 3) -> DataFrame:
    """(id, status, items): questions with reasoning and answer for every abstract that is not put aside. An item that
    fails, or lacks reasoning or answer, is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = provider(name)
        for b in batches:
            status, items = [], []
            for abstract in b.column(1).to_pylist():
                made = []
                aside = not abstract or own.describe(abstract).get("useless", False)
                for question in [] if aside else own.ask(abstract, count):
                    try:
                        reasoning = own.reason(question) if question else ""
                        answer = own.answer(question, reasoning) if reasoning else ""
                    except Exception:  # noqa: BLE001 - one failed item does not fail its text
                        continue
                    if answer:
                        made.append({"question": question, "reasoning": reasoning, "answer": answer})
                status.append(ASIDE if aside else DONE)
                items.append(made)
            kind = pa.list_(pa.struct([(c, pa.string()) for c in ("question", "reasoning", "answer")]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(status, pa.string()), pa.array(items, kind)], names=["id", "status", "items"])

    return abstract_rows.select("id", "abstract").mapInArrow(run, _MADE)


def flattened(made: DataFrame, model: str) -> DataFrame:
    """One row (id, question, reasoning, answer, model) per item of done texts."""
    rows = made.where(F.col("status") == DONE)
    return rows.select("id", F.inline("items")).withColumn("model", F.lit(model))


def complete(rows: DataFrame, with_reasoning: bool = False) -> DataFrame:
    """Rows with question and answer (and reasoning) that are not empty."""
    for c in ("question", "answer", *(("reasoning",) if with_reasoning else ())):
        rows = rows.where(F.coalesce(F.col(c) != "", F.lit(False)))
    return rows


def canonical_model(names: dict[str, str], column: str = "model") -> F.Column:
    """The canonical name of a model, itself where it has no alias."""
    out = F.col(column)
    for alias, name in names.items():
        out = F.when(F.col(column) == alias, F.lit(name)).otherwise(out)
    return out


def retried(rows: DataFrame, attempt, retryable) -> DataFrame:
    """``attempt(rows)`` gives (…, error); rows whose error is retryable are attempted once more.

    The first attempt's rows are written, so no call is made again for the rows that succeeded.
    """
    from quern.runtime import written

    first = written(attempt(rows), "attempt")
    again = F.coalesce(retryable("error"), F.lit(False)) & F.col("error").isNotNull()
    second = attempt(first.where(again).select(*rows.columns))
    return first.where(~again).unionByName(second)

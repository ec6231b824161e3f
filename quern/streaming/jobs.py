"""Queues as folders of JSON files, consumed as streams in micro-batches.

A queue folder is written by :func:`push` and read by :func:`queue`; a job drains it (``availableNow``) or keeps
running. Batches are retried from the checkpoint, so each sink either skips keys it has or replaces whole batches:
delivery is at least once and the outcome the same. Rejected tasks go to a side folder instead of being dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quern.operators import ingest


def push(rows: DataFrame, folder: str) -> None:
    """Append a queue's payloads, one JSON object a row."""
    rows.write.mode("append").json(folder)


def queue(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """A queue as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def consume(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, rejected: str | None = None, drain: bool = True, every: str = "10 seconds") -> StreamingQuery:
    """Run ``work(valid tasks, batch number)`` on every micro-batch; tasks without id go to ``rejected``."""

    def batch(rows: DataFrame, number: int) -> None:
        good, bad = ingest.valid_tasks(rows)
        if rejected:
            bad.write.mode("overwrite").json(f"{rejected}/batch={number}")
        work(good, number)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if drain else writer.trigger(processingTime=every).start()


def fan_out(rows: DataFrame, sinks: dict[str, tuple[str, list[str]]], number: int) -> None:
    """Write one batch to several queues (name: folder, columns); a batch that runs again replaces its own files."""
    rows = rows.persist()
    try:
        for folder, columns in sinks.values():
            rows.select(*columns).write.mode("overwrite").json(f"{folder}/batch={number}")
    finally:
        rows.unpersist()


def distinct_rows(stream: DataFrame, keys: list[str], time: str | None = None, late: str | None = None) -> DataFrame:
    """The first row of each key. With an event time and a bound for lateness, state older than the bound is dropped;
    without, it grows with the number of keys, and an insert that skips known keys is the better choice."""
    if time and late:
        return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def unseen(rows: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """A micro-batch's rows whose key the target table lacks: stateless de-duplication across batches and runs."""
    return rows.where(F.col(key).isNotNull()).dropDuplicates([key]).join(target.select(key), key, "left_anti")


def to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain a stream into a Parquet folder, each row exactly once."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)

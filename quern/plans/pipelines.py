"""Queries on the provider-backed pipelines (with the default provider) and on streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import jsons
from quern.operators import clean, embedding, qa
from quern.plans.registry import query
from quern.plans.texts import _RAW, raw
from quern.runtime import shared_dir, table
from quern.sources import schemas
from quern.streaming import jobs


@query(f"select id, coalesce(length(text) >= 100, false) as admitted from {_RAW}")
def clean_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records are long enough to be cleaned."""
    yes, no = clean.admitted(raw(spark, sf_dir, "text"))
    return yes.select("id", F.lit(True).alias("admitted")).unionByName(no.select("id", F.lit(False).alias("admitted")))


@query()
def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records with their metadata."""
    rows = clean.admitted(raw(spark, sf_dir, "title", "text", "url", "language", "extracted_at"))[0]
    done, _ = clean.recomposed(clean.cleaned(rows))
    return done.select(jsons.field("metadata", "raw_id").alias("raw_id"), jsons.field("metadata", "difficulty").alias("difficulty"), jsons.field("metadata", "char_count").cast("long").alias("chars"), F.md5("text").alias("text"))


@query()
def qa_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer rows of all records: abstracts (long texts in parts), routing, flattening."""
    made = qa.generated(qa.abstracts(raw(spark, sf_dir, "text"), most=16_000, size=12_000, overlap=1_000))
    return qa.complete(qa.flattened(made, "offline"), with_reasoning=True)


@query("select id, case when coalesce(reasoning is null or length(reasoning) < 20, false) or coalesce(answer = '', true) then 'put_aside' else 'done' end as status from (select id, any_value(reasoning) as reasoning, any_value(answer) as answer from qa_dataset group by id)")
def route_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows put aside: useless ones and ones without an abstract (here the answer)."""
    rows = table(spark, sf_dir, "qa_dataset").dropDuplicates(["id"]).select("id", F.col("answer").alias("abstract"), (F.col("reasoning").isNull() | (F.length("reasoning") < 20)).alias("useless"))
    return qa.routed(rows).select("id", "status")


@query("select distinct id, question, answer, 'm' as model from qa_dataset where question <> '' and answer <> ''")
def qa_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows nested by record and flattened again, without those that lack question or answer."""
    item = F.struct("question", "reasoning", "answer")
    nested = table(spark, sf_dir, "qa_dataset").distinct().groupBy("id").agg(F.collect_list(item).alias("items")).withColumn("status", F.lit(qa.DONE))
    return qa.complete(qa.flattened(nested, "m")).select("id", "question", "answer", "model").distinct()


@query()
def embed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of 500 tokens of all records with their vectors."""
    rows = embedding.chunk_rows(raw(spark, sf_dir, "text"), "raw_corpus", size=500)
    return rows.select("record_id", "chunk_index", F.size("embedding").alias("size"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x), 6).alias("norm"))


@query("select user_id, event_type from events where user_id is not null group by user_id, event_type")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (user, type) pairs of the events as a drained stream."""
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    source = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).where("user_id is not null")
    jobs.to_table(jobs.distinct_rows(stream.select("user_id", "event_type"), ["user_id", "event_type"]), f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(f"{out}/rows")


@query(f"select id, 'raw_corpus' as \"table\", 'embed' as queue from {_RAW} where id <> '' union all select id, 'qa', 'qa' from {_RAW} where id <> ''")
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue of records drained into two further queues."""
    root = f"{shared_dir(spark)}/queues-{uuid.uuid4().hex}"
    jobs.push(raw(spark, sf_dir).select("id"), f"{root}/clean")

    def work(rows: DataFrame, number: int) -> None:
        both = rows.select("id", F.lit("main").alias("database"), F.lit("raw_corpus").alias("table"), F.lit("text").alias("source_column"), F.lit("embedding").alias("target_column"), F.col("id").alias("raw_id"))
        jobs.fan_out(both, {"embed": (f"{root}/embed", schemas.EMBED_TASK.names), "qa": (f"{root}/qa", schemas.QA_TASK.names)}, number)

    jobs.consume(jobs.queue(spark, f"{root}/clean", schemas.CLEAN_TASK), work, f"{root}/checkpoint", f"{root}/rejected").awaitTermination()
    embed = spark.read.schema(schemas.EMBED_TASK).json(f"{root}/embed").select("id", "table", F.lit("embed").alias("queue"))
    return embed.unionByName(spark.read.schema(schemas.QA_TASK).json(f"{root}/qa").select("id", F.lit("qa").alias("table"), F.lit("qa").alias("queue")))

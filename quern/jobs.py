"""The pipelines end to end over a table store, and their command line.

Each job reads the store, computes all changed tables and publishes them at once, so a job that fails leaves the store as
it was and can be run again; ids come from natural keys, so a second run adds nothing.

    python -m quern.jobs STORE backfill RAW_FOLDER QA_FOLDER [--limit N] [--queues FOLDER]
    python -m quern.jobs STORE clean | embed TABLE | generate | audit
"""

from __future__ import annotations

import argparse
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import jsons, text
from quern.operators import audit as auditing
from quern.operators import clean as cleaning
from quern.operators import embedding, ingest, models, qa, writes
from quern.runtime import scratch, written
from quern.sources import schemas
from quern.sources.files import Store, json_lines, listed, raw_files
from quern.streaming import jobs as streams


def _clean_after(job):
    """Delete a job's intermediate tables when it is done."""

    @functools.wraps(job)
    def run(store: Store, *args, **kwargs):
        with scratch(store.spark):
            return job(store, *args, **kwargs)

    return run


def _kept(rows: DataFrame) -> DataFrame:
    """A few rows (one a file or flag) that outlive the tables they come from."""
    return rows.sparkSession.createDataFrame(rows.collect(), rows.schema)


def _joined(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(schemas.conform(new, old.schema))


@_clean_after
def backfill(store: Store, raw_folder: str, qa_folder: str, names: list[str], limit: int | None = None, queues: str | None = None) -> DataFrame:
    """(file, raw, corpus, qa): rows added by file. Raw files come in by url; those with a question file also give cleaned
    rows and question rows, linked by source. Without one their new rows are queued for cleaning."""
    spark = store.spark
    pairs = ingest.paired_files(listed(spark, raw_folder, ".parquet").select("path"), listed(spark, qa_folder, ".jsonl").select("path"))
    # File names, not rows: the listing is what the readers below need on the driver.
    chosen = (pairs.orderBy("path").limit(limit) if limit and limit > 0 else pairs).collect()
    if not chosen:
        return spark.createDataFrame([], "file string, raw long, corpus long, qa long")
    known = spark.createDataFrame([(r["path"].rsplit("/", 1)[-1],) for r in chosen if r["has_qa"]], "file string")
    files = raw_files(spark, *[r["path"] for r in chosen]).withColumn("file", text.base_name("file"))
    rows = written(ingest.raw_rows(files, names, known), "backfill")
    raw, corpus, questions = (store.read(n) for n in ("raw_corpus", "corpus", "qa_dataset"))
    new_raw = written(writes.insert_ignore(raw, rows.select("file", "position", *raw.columns), "url", "file", "position"), "backfill-raw")
    clean = ingest.corpus_rows(writes.first_of(rows.join(known, "file", "left_semi"), ["url"], "file", "position"))
    new_corpus = written(writes.insert_ignore(corpus, clean, "id", "file"), "backfill-corpus")
    places = rows.join(known, "file", "left_semi").select("file", "position", "url", F.sha2(F.concat_ws("\x1f", F.lit("corpus"), "url"), 256).alias("id"))
    paths = [r["qa_path"] for r in chosen if r["has_qa"]]
    if paths:
        lines = json_lines(spark, schemas.QA_LINE, *paths, defaults={"reasoning": "", "model": "unknown", "source": ""})
        lines = lines.withColumns({"qa_file": F.col("file"), "file": text.paired_name("file", ".jsonl", ".parquet")}).withColumns({c: text.without_nul(c) for c in schemas.QA_LINE.names})
        linked = ingest.linked_questions(lines, places)
        made = linked.withColumns({"id": F.sha2(F.concat_ws("\x1f", F.lit("qa"), "file", "question", "reasoning", "answer"), 256), "embedding": F.lit(None).cast("array<double>"), "metadata": jsons.metadata(corpus_id="corpus_id", source_file="qa_file")})
        new_qa = written(writes.insert_ignore(questions, made.select("file", *questions.columns), "id", "file"), "backfill-qa")
    else:
        new_qa = spark.createDataFrame([], schemas.QA).withColumn("file", F.lit(None).cast("string"))
    store.publish({"raw_corpus": _joined(raw, new_raw), "corpus": _joined(corpus, new_corpus), "qa_dataset": _joined(questions, new_qa)})
    if queues:
        streams.push(_embed_tasks(new_corpus, "corpus", "text").unionByName(_embed_tasks(new_qa, "qa_dataset", "question")), f"{queues}/embed")
        streams.push(new_raw.where("not processed_clean").select("id"), f"{queues}/clean")
    return _kept(ingest.file_counts(new_raw, new_corpus, new_qa))


def _embed_tasks(rows: DataFrame, table: str, column: str) -> DataFrame:
    return rows.select("id", F.lit("main").alias("database"), F.lit(table).alias("table"), F.lit(column).alias("source_column"), F.lit("embedding").alias("target_column"))


@_clean_after
def clean(store: Store, provider: str = "offline", queues: str | None = None) -> dict[str, int]:
    """Clean all records not yet processed; too short ones and ones without a result only count as processed."""
    raw, corpus = store.read("raw_corpus"), store.read("corpus")
    todo = raw.where(~F.coalesce("processed_clean", F.lit(False)))
    rows = written(cleaning.cleaned(cleaning.admitted(todo)[0], provider), "cleaned")
    done, _ = cleaning.recomposed(rows)
    new = written(writes.insert_ignore(corpus, done, "id", "url"), "clean-new")
    store.publish({"corpus": _joined(corpus, new), "raw_corpus": writes.set_flag(raw, todo.select("id"), "id", "processed_clean")})
    if queues:
        streams.push(_embed_tasks(new, "corpus", "text"), f"{queues}/embed")
        streams.push(new.select("id", jsons.field("metadata", "raw_id").alias("raw_id")), f"{queues}/qa")
    return {"cleaned": new.count(), "processed": rows.count()}


@_clean_after
def embed(store: Store, table: str, ids: DataFrame | None = None, column: str = "text", provider: str = "offline", size: int = 8_000) -> int:
    """Replace the pieces of a table's records (all, or those of ``ids``), and set the vector of what their metadata say."""
    rows, chunks = store.read(table), store.read("embeddings_chunks")
    picked = rows.join(ids.select("id").distinct(), "id", "left_semi") if ids is not None else rows
    new = written(embedding.chunk_rows(picked.select("id", F.col(column).alias("text")), table, provider, size), "chunks")
    changed = {"embeddings_chunks": writes.replace_records(chunks, new, ["table_name", "record_id"])}
    if table in ("corpus", "conversations_dataset"):
        described = picked.select("id", embedding.metadata_text(table).alias("described")).where("described is not null")
        changed[table] = writes.update(rows, embedding.embedded(described, "described", provider).select("id", "embedding"), "id", "embedding")
    store.publish(changed)
    return new.count()


@_clean_after
def generate(store: Store, provider: str = "offline", model: str = "offline") -> int:
    """Questions for the cleaned texts whose raw record has none yet; the answers' vectors are stored as pieces."""
    raw, corpus, questions, chunks = (store.read(n) for n in ("raw_corpus", "corpus", "qa_dataset", "embeddings_chunks"))
    todo = raw.where("processed_clean and not coalesce(processed_qa, false)").select(F.col("id").alias("raw_id"))
    texts = corpus.withColumn("raw_id", jsons.field("metadata", "raw_id")).join(todo, "raw_id", "left_semi")
    made = qa.complete(qa.flattened(qa.generated(qa.abstracts(texts.select("id", "text"), provider), provider), model))
    about = texts.select("id", "raw_id", text.source_of("url", "title").alias("source"))
    rows = made.join(about, "id").withColumns({"metadata": jsons.metadata(corpus_id="id", raw_id="raw_id"), "id": F.sha2(F.concat_ws("\x1f", F.lit("qa"), "id", "question"), 256)})
    rows = embedding.embedded(rows, "question", provider)
    new = written(writes.insert_ignore(questions, rows.select(*questions.columns), "id", "question"), "generated")
    answers = embedding.chunk_rows(new.select("id", F.col("answer").alias("text")), "qa_dataset", provider).where("chunk_index = 0")
    store.publish({"qa_dataset": _joined(questions, new), "embeddings_chunks": _joined(chunks, answers), "raw_corpus": writes.set_flag(raw, todo.select(F.col("raw_id").alias("id")), "id", "processed_qa")})
    return new.count()


@_clean_after
def audit(store: Store, provider: str | None = "offline") -> DataFrame:
    """Move flagged rows to quarantine and return the report; rows already there are not added again."""
    questions, chunks, held = (store.read(n) for n in ("qa_dataset", "embeddings_chunks", "qa_dataset_quarantine"))
    rows = written(auditing.judged(auditing.scored(questions, chunks, provider)), "audit")
    moved = auditing.quarantine(questions, chunks, rows)
    moved["qa_dataset_quarantine"] = _joined(held, writes.insert_ignore(held, moved["qa_dataset_quarantine"], "id", "audited_at"))
    store.publish(moved)
    return _kept(auditing.reported(rows, bool(provider)))


def sync_models(store: Store, found: dict[str, list[str]]) -> int:
    """The registry after the listed models were seen now."""
    new = models.discovered(store.spark, found).withColumn("last_seen", F.current_timestamp())
    store.publish({"available_models": writes.upsert(store.read("available_models"), new, ["provider", "model_id"], "last_seen")})
    return store.read("available_models").count()


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quern.jobs", description=__doc__.splitlines()[0])
    parser.add_argument("store")
    kinds = parser.add_subparsers(dest="job", required=True)
    one = kinds.add_parser("backfill")
    one.add_argument("raw_folder")
    one.add_argument("qa_folder")
    one.add_argument("--limit", type=int, default=0)
    one.add_argument("--queues")
    one.add_argument("--names", nargs="*", default=[])
    kinds.add_parser("embed").add_argument("table")
    for name in ("clean", "generate", "audit"):
        kinds.add_parser(name)
    given = parser.parse_args(args)
    store = Store(SparkSession.builder.appName("quern").config("spark.sql.session.timeZone", "UTC").getOrCreate(), given.store)
    if given.job == "backfill":
        backfill(store, given.raw_folder, given.qa_folder, given.names, given.limit, given.queues).show(1000, False)
    elif given.job == "audit":
        audit(store).show(truncate=False)
    else:
        print({"clean": lambda: clean(store), "generate": lambda: generate(store), "embed": lambda: embed(store, given.table)}[given.job]())


if __name__ == "__main__":
    main()

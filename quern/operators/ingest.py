"""Backfill of raw and question files: pairing, filling in, linking, counting.

Ids are made from natural keys, so a second run gives the same rows and the inserts skip them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import jsons, text
from quern.operators import writes


def pending_files(raw: DataFrame, done: DataFrame, most: int | None = None) -> DataFrame:
    """Paths of raw files whose paired output does not exist, the first ``most`` by path (all for null, 0 or less)."""
    names = done.select(text.base_name("path").alias("_paired")).distinct()
    left = raw.withColumn("_paired", text.paired_name("path")).join(names, "_paired", "left_anti").drop("_paired")
    return left.orderBy("path").limit(most) if most and most > 0 else left


def paired_files(raw: DataFrame, questions: DataFrame) -> DataFrame:
    """Each raw file with the question file of the same base name, if any, and ``has_qa``."""
    own = questions.select(text.base_name("path").alias("_paired"), F.col("path").alias("qa_path")).groupBy("_paired").agg(F.min("qa_path").alias("qa_path"))
    return raw.withColumn("_paired", text.paired_name("path")).join(own, "_paired", "left").drop("_paired").withColumn("has_qa", F.col("qa_path").isNotNull())


def raw_rows(files: DataFrame, names: list[str], has_qa: DataFrame | None = None) -> DataFrame:
    """Rows for the raw table from (columns of a raw file, file): values without U+0000, a url for every row, the
    source by file name, both processed flags set where the file has its questions (``has_qa``: file)."""
    clean = {c: text.without_nul(c) for c in ("title", "text", "url", "language")}
    key = F.concat_ws("\x1f", "file", "title", "text")
    out = files.withColumns(clean).withColumn("url", text.url_or_generated("url", key)).withColumn("id", F.sha2(F.concat_ws("\x1f", F.lit("raw"), "url"), 256))
    out = out.withColumn("spider_name", text.first_contained(text.base_name("file"), names))
    known = has_qa.select("file").distinct().withColumn("_qa", F.lit(True)) if has_qa is not None else None
    out = out.join(known, "file", "left") if known is not None else out.withColumn("_qa", F.lit(None).cast("boolean"))
    done = F.col("_qa").isNotNull()
    return out.withColumns({"processed_clean": done, "processed_qa": done}).drop("_qa")


def corpus_rows(rows: DataFrame) -> DataFrame:
    """Rows for the cleaned table from :func:`raw_rows`; ``raw_id`` is the id of the raw row that bears the url."""
    meta = jsons.metadata(raw_id="id", source_file="file", char_count="char_count")
    return rows.select(F.sha2(F.concat_ws("\x1f", F.lit("corpus"), "url"), 256).alias("id"), "title", "text", "url", "language", "extracted_at", F.lit(None).cast("array<double>").alias("embedding"), meta.alias("metadata"), "file")


def linked_questions(questions: DataFrame, corpus: DataFrame) -> DataFrame:
    """Question rows (file, source, …) with ``corpus_id``: the last of the file's rows that has the source as url, else
    the file's first row; ``matched`` tells which. ``corpus``: (file, position, url, id), paired by file."""
    by_file = Window.partitionBy("file")
    places = corpus.select("file", "url", "id", "position").withColumn("_first", F.min("position").over(by_file))
    match = corpus.groupBy("file", F.col("url").alias("source")).agg(F.max_by("id", "position").alias("_match"))
    # A url that comes twice keeps its first place in the file but has the id of its last row.
    lead = places.where("position = _first").select("file", F.col("url").alias("_lead"))
    first = match.join(lead, (match.file == lead.file) & match.source.eqNullSafe(lead._lead)).select(match.file, F.col("_match").alias("_head"))
    out = questions.join(match, ["file", "source"], "left").join(first, "file", "left")
    return out.withColumn("matched", F.col("_match").isNotNull()).withColumn("corpus_id", F.coalesce("_match", "_head")).drop("_match", "_head")


def file_counts(raw: DataFrame, corpus: DataFrame, questions: DataFrame) -> DataFrame:
    """(file, raw, corpus, qa): rows of each kind by file, files of any kind, 0 where a kind has none."""
    parts = [df.groupBy("file").agg(F.count("*").alias("n")).select("file", F.lit(kind).alias("kind"), "n") for kind, df in (("raw", raw), ("corpus", corpus), ("qa", questions))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("file").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("raw", "corpus", "qa")])


def batch_summary(rows: DataFrame) -> DataFrame:
    """One row of totals over (file, status, qa, error): files, rows, rows put aside, questions and the sorted errors."""
    return rows.agg(
        F.count_distinct("file").alias("files_processed"),
        F.count("*").alias("rows_total"),
        F.count_if(F.col("status") == "put_aside").alias("rows_discarded"),
        F.coalesce(F.sum("qa"), F.lit(0)).cast("long").alias("qa_generated"),
        F.count("error").alias("errors"),
    )


def new_topics(topics: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(topics to add, (added, duplicates)) of stripped topics that are not empty, against those known already."""
    given = topics.select(text.strip("topic").alias("topic")).where("topic <> ''")
    added = writes.insert_ignore(known.select("topic"), given.withColumn("_at", F.lit(0)), "topic", "_at").select("topic")
    counts = given.agg(F.count("*").alias("_n")).crossJoin(added.agg(F.count("*").alias("added"))).select("added", (F.col("_n") - F.col("added")).alias("duplicates"))
    return added, counts


def task_groups(tasks: DataFrame) -> DataFrame:
    """(database, table, source_column, tasks) of valid queue tasks."""
    return valid_tasks(tasks)[0].groupBy("database", "table", "source_column").agg(F.count("*").alias("tasks"))


def valid_tasks(tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tasks with an id, tasks without)."""
    ok = F.col("id").isNotNull() & (F.col("id") != "")
    return tasks.where(ok), tasks.where(~ok)


def long_enough(df: DataFrame, bounds: dict[str, int], by: str, default: int) -> DataFrame:
    """Rows whose text is longer than their kind's bound and whose title is not empty where the kind asks for one."""
    bound = F.lit(default)
    for name, size in bounds.items():
        bound = F.when(F.col(by) == name, F.lit(size)).otherwise(bound)
    return df.where(F.length("text") > bound)

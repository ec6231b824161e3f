"""Queries on scans, pairings and changes of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import ingest, models, writes
from quern.plans.registry import query
from quern.runtime import table
from quern.sources import schemas

#: Old and new halves of a table, by the first character of the id.
_OLD = "id < '8'"


@query("select id, any_value(question) as question, any_value(model) as model from qa_dataset where model is not null group by id")
def qa_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the question table that are asked for, conformed to its schema."""
    rows = schemas.conform(table(spark, sf_dir, "qa_dataset"), schemas.QA, required=("question",))
    return rows.where("model is not null").select("id", "question", "model").dropDuplicates(["id"])


@query("select id, any_value(record_id) as record_id from embeddings_chunks where table_name = 'qa_dataset' and chunk_index = 0 group by id")
def first_chunk_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces by pushed-down conditions."""
    return table(spark, sf_dir, "embeddings_chunks").where("table_name = 'qa_dataset' and chunk_index = 0").select("id", "record_id").dropDuplicates(["id"])


@query("select distinct id, record_id from embeddings_chunks where record_id in (select id from qa_dataset) or record_id in (select json_extract_string(metadata, '$.raw_id') from qa_dataset where json_valid(metadata))")
def member_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the records that question rows name, by semi-join instead of lists of ids."""
    qa = table(spark, sf_dir, "qa_dataset")
    ids = qa.select(F.col("id").alias("record_id")).unionByName(qa.select(F.get_json_object("metadata", "$.raw_id").alias("record_id")))
    return table(spark, sf_dir, "embeddings_chunks").select("id", "record_id").join(ids, "record_id", "left_semi").select("id", "record_id").distinct()


@query("select distinct r.id, r.title from raw_corpus r join (select distinct json_extract_string(metadata, '$.raw_id') as id from qa_dataset where json_valid(metadata)) t using (id)")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a batch of tasks."""
    tasks = table(spark, sf_dir, "qa_dataset").select(F.get_json_object("metadata", "$.raw_id").alias("id")).distinct()
    return table(spark, sf_dir, "raw_corpus").select("id", "title").join(tasks, "id").select("id", "title").distinct()


_PATHS = "(select distinct 'raw/' || coalesce(spider_name, 'none') || '/part-' || substr(id, 1, 2) || '.parquet' as path from raw_corpus)"
_DONE = "(select distinct 'qa/part-' || substr(id, 1, 2) || '.jsonl' as path from raw_corpus where processed_qa)"


def _paths(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "raw_corpus").select("id", "spider_name", "processed_qa")
    name = F.concat(F.lit("part-"), F.substring("id", 1, 2))
    raw = rows.select(F.concat(F.lit("raw/"), F.coalesce("spider_name", F.lit("none")), F.lit("/"), name, F.lit(".parquet")).alias("path")).distinct()
    return raw, rows.where("processed_qa").select(F.concat(F.lit("qa/"), name, F.lit(".jsonl")).alias("path")).distinct()


@query(f"select path from {_PATHS} where replace(list_extract(string_split(path, '/'), -1), '.parquet', '.jsonl') not in (select list_extract(string_split(path, '/'), -1) from {_DONE})")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files without their questions."""
    return ingest.pending_files(*_paths(spark, sf_dir))


@query(f"select p.path, min(d.path) as qa_path, min(d.path) is not null as has_qa from {_PATHS} p left join {_DONE} d on list_extract(string_split(d.path, '/'), -1) = replace(list_extract(string_split(p.path, '/'), -1), '.parquet', '.jsonl') group by p.path")
def paired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files and the question file each has."""
    return ingest.paired_files(*_paths(spark, sf_dir))


_PLACED = "(select spider_name as file, url, id, extracted_at || id as position from (select * from raw_corpus qualify row_number() over (partition by id order by id) = 1) where url is not null and spider_name is not null and extracted_at is not null)"
_LINKS = "(select id, source, json_extract_string(metadata, '$.raw_id') as raw_id from (select id, any_value(source) as source, any_value(metadata) as metadata from qa_dataset where json_valid(metadata) group by id))"


@query(
    f"""with c as (select file, url, id, strftime(extracted_at, '%Y-%m-%d %H:%M:%S.%f') || id as position from (
    select spider_name as file, url, id, extracted_at at time zone 'UTC' as extracted_at from (select * from raw_corpus qualify row_number() over (partition by id order by id) = 1) where url is not null and spider_name is not null and extracted_at is not null)),
q as (select l.id, l.source, r.spider_name as file from {_LINKS} l join (select id, any_value(spider_name) as spider_name from raw_corpus group by id) r on r.id = l.raw_id where r.spider_name is not null),
last_ as (select file, url, arg_max(id, position) as id from c group by file, url),
lead_ as (select file, arg_min(url, position) as url from c group by file)
select q.id, coalesce(m.id, h.id) as corpus_id, m.id is not null as matched
from q left join last_ m on m.file = q.file and m.url = q.source left join lead_ l on l.file = q.file left join last_ h on h.file = l.file and h.url = l.url"""
)
def qa_source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question rows linked to the record with their source's url in the same file, else to the file's first record."""
    rows = table(spark, sf_dir, "raw_corpus").select("id", "url", "spider_name", "extracted_at").dropDuplicates(["id"])
    position = F.concat(F.date_format("extracted_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "id")
    corpus = rows.where("url is not null and spider_name is not null and extracted_at is not null").select(F.col("spider_name").alias("file"), "url", "id", position.alias("position"))
    qa = table(spark, sf_dir, "qa_dataset").dropDuplicates(["id"]).select("id", "source", F.get_json_object("metadata", "$.raw_id").alias("raw_id"))
    questions = qa.join(rows.select(F.col("id").alias("raw_id"), F.col("spider_name").alias("file")), "raw_id").where("file is not null").select("id", "source", "file")
    return ingest.linked_questions(questions, corpus).select("id", "corpus_id", "matched")


@query("select spider_name as file, count(*) as raw, count(*) filter (processed_clean) as corpus, count(*) filter (processed_qa) as qa from raw_corpus where spider_name is not null group by spider_name")
def file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each kind by file."""
    rows = table(spark, sf_dir, "raw_corpus").where("spider_name is not null").select(F.col("spider_name").alias("file"), "processed_clean", "processed_qa")
    return ingest.file_counts(rows, rows.where("processed_clean"), rows.where("processed_qa"))


@query("select count(distinct spider_name) as files_processed, count(*) as rows_total, count(*) filter (not processed_clean) as rows_discarded, cast(sum(length(title)) as bigint) as qa_generated, count(language) as errors from raw_corpus")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a batch."""
    rows = table(spark, sf_dir, "raw_corpus").select(F.col("spider_name").alias("file"), F.when(~F.col("processed_clean"), F.lit("put_aside")).otherwise(F.lit("done")).alias("status"), F.length("title").alias("qa"), F.col("language").alias("error"))
    return ingest.batch_summary(rows)


_ADDED = f"(select url, arg_min(id, id) as id from raw_corpus where not {_OLD} and url is not null group by url) a"


@query(f"select id, url from {_ADDED} where url not in (select url from raw_corpus where {_OLD} and url is not null) union all select id, url from raw_corpus where not {_OLD} and url is null")
def url_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an insert of half the records adds to the other half, by url; the first of each url."""
    rows = table(spark, sf_dir, "raw_corpus").select("id", "url")
    return writes.insert_ignore(rows.where(_OLD), rows.where(f"not ({_OLD})"), "url", "id")


@query("select id, count(*) as rows from (select distinct id from qa_dataset where id is not null) where id not in (select id from qa_dataset where model = (select min(model) from qa_dataset)) group by id")
def id_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an insert of all question rows adds to those of one model, by id."""
    rows = table(spark, sf_dir, "qa_dataset").select("id", "model")
    first = rows.agg(F.min("model").alias("model"))
    known = rows.join(first, "model", "left_semi")
    return writes.insert_ignore(known, rows.where("id is not null"), "id", "model").groupBy("id").agg(F.count("*").alias("rows"))


@query("select provider, model_id, max(s) as last_seen from (select provider, model_id, coalesce(strftime(last_seen at time zone 'UTC', '%Y-%m-%d %H:%M:%S'), '') as s from available_models where provider is distinct from (select min(provider) from available_models) union all select provider, model_id, '2030-01-01 00:00:00' from available_models where provider = (select min(provider) from available_models) union all select 'new', 'model', '2030-01-01 00:00:00') group by provider, model_id")
def model_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after one provider's models were seen again and a new one came."""
    known = table(spark, sf_dir, "available_models")
    seen = known.join(known.agg(F.min("provider").alias("provider")), "provider", "left_semi").select("provider", "model_id")
    new = seen.unionByName(spark.createDataFrame([("new", "model")], "provider string, model_id string")).withColumn("last_seen", F.lit("2030-01-01 00:00:00").cast("timestamp"))
    out = writes.upsert(known, new, ["provider", "model_id"], "last_seen")
    return out.select("provider", "model_id", F.coalesce(F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("last_seen"))


@query("with m as (select distinct provider || ': ' || model_id as entry from available_models), p as (select max(entry) as entry from m) select cast(case when m.entry = p.entry then 0 else 1 end as integer) as rank, m.entry from m, p union all select 2, 'other' order by 1, 2")
def model_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry in order, a preferred entry first, an extra one last."""
    known = table(spark, sf_dir, "available_models")
    preferred = known.agg(F.max(F.concat_ws(": ", "provider", "model_id"))).first()[0]
    return models.listed(known, [preferred] if preferred else [], ["spare: model"], "other")


@query("select model_id from available_models where contains(lower(model_id), 'gemma-4-26b') or not (contains(lower(model_id), 'tts') or contains(lower(model_id), 'image') or contains(lower(model_id), 'robotics') or contains(lower(model_id), 'computer-use') or contains(lower(model_id), 'clip') or contains(lower(model_id), 'lyria') or contains(lower(model_id), 'nano-banana') or contains(lower(model_id), 'antigravity') or contains(lower(model_id), 'deep-research')) union all select unnest(['gemma-4-26b-image', 'plain'])")
def model_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that write text."""
    made = spark.createDataFrame([("gemma-4-26b-image", ["generateContent"]), ("x-tts", ["generateContent"]), ("plain", ["generateContent", "count"]), ("mute", ["embed"])], "name string, methods array<string>")
    known = table(spark, sf_dir, "available_models").select(F.col("model_id").alias("name"), F.array(F.lit("generateContent")).alias("methods"))
    return models.usable(known.unionByName(made)).select(F.col("name").alias("model_id"))


@query("with r as (select distinct record_id from embeddings_chunks where chunk_index = 0 and table_name = 'qa_dataset') select record_id, count(*) as pieces, count(*) filter (chunk_text = 'new') as fresh from (select record_id, chunk_text from embeddings_chunks where record_id is not null and record_id not in (select record_id from r where record_id is not null) union all select record_id, 'new' from r) group by record_id")
def chunk_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces after those of some records were replaced by one new piece each."""
    rows = table(spark, sf_dir, "embeddings_chunks").where("record_id is not null").select("record_id", "chunk_text")
    new = table(spark, sf_dir, "embeddings_chunks").where("chunk_index = 0 and table_name = 'qa_dataset' and record_id is not null").select("record_id").distinct().withColumn("chunk_text", F.lit("new"))
    return writes.replace_records(rows, new, ["record_id"]).groupBy("record_id").agg(F.count("*").alias("pieces"), F.count_if(F.col("chunk_text") == "new").alias("fresh"))


@query("select q.id, cast(max(len(coalesce(c.e, q.embedding))) as integer) as size from qa_dataset q left join (select record_id, arg_min(embedding, id) as e from embeddings_chunks where table_name = 'qa_dataset' and chunk_index = 0 and embedding is not null group by record_id) c on c.record_id = q.id where q.id is not null group by q.id")
def vector_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question rows after their vectors were set from the stored pieces."""
    rows = table(spark, sf_dir, "qa_dataset").where("id is not null").select("id", "embedding").dropDuplicates(["id"])
    own = table(spark, sf_dir, "embeddings_chunks").where("table_name = 'qa_dataset' and chunk_index = 0 and embedding is not null").groupBy(F.col("record_id").alias("id")).agg(F.min_by("embedding", "id").alias("embedding"))
    return writes.update(rows, own, "id", "embedding").select("id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("size"))


@query("select id, bool_or(coalesce(processed_qa, false) or id in (select json_extract_string(metadata, '$.raw_id') from qa_dataset where json_valid(metadata) and json_extract_string(metadata, '$.raw_id') is not null)) as done from raw_corpus group by id")
def flag_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records after those with questions were marked."""
    rows = table(spark, sf_dir, "raw_corpus").select("id", F.coalesce("processed_qa", F.lit(False)).alias("done")).distinct()
    ids = table(spark, sf_dir, "qa_dataset").select(F.get_json_object("metadata", "$.raw_id").alias("id")).where("id is not null")
    return writes.set_flag(rows, ids, "id", "done").groupBy("id").agg(F.bool_or("done").alias("done"))


@query("select event_type, count(*) as tasks from events where user_id is not null and event_type <> '' group by event_type")
def task_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid queue tasks by table."""
    tasks = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), F.lit("main").alias("database"), F.col("event_type").alias("table"), F.lit("text").alias("source_column"))
    return ingest.task_groups(tasks.where("table <> ''")).select(F.col("table").alias("event_type"), "tasks")


_TOPIC = r"regexp_replace(title, '^\s+|\s+$', '', 'g')"


@query(f"with t as (select {_TOPIC} as topic, {_OLD} as old from raw_corpus where title is not null), n as (select topic from t where not old and topic <> '') select (select count(distinct topic) from n where topic not in (select topic from t where old)) as added, (select count(*) from n) - (select count(distinct topic) from n where topic not in (select topic from t where old)) as duplicates")
def topic_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of half the titles are new to the other half, and how many are not."""
    from quern.functions.text import strip

    titles = table(spark, sf_dir, "raw_corpus").where("title is not null").select("id", strip("title").alias("topic"))
    return ingest.new_topics(titles.where(f"not ({_OLD})").select("topic"), titles.where(_OLD).select("topic"))[1]

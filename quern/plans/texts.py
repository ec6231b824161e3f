"""Queries on the scalar operators: text, JSON, vectors, errors, markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import errors, jsons, markup, text, vectors
from quern.operators import chunks, ingest, qa
from quern.plans.registry import query
from quern.runtime import table

_W = text.WHITE
#: The rows of raw_corpus, each delivered id once.
_RAW = "(select * from raw_corpus qualify row_number() over (partition by id order by id) = 1)"
_STRIP = rf"regexp_replace(text, '^[{_W}]+|[{_W}]+$', '', 'g')"


def raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "raw_corpus").select("id", *columns).dropDuplicates(["id"])


@query(f"select id, cast(length(text) as bigint) as chars, cast(len(regexp_extract_all(text, '[^{_W}]+')) as bigint) as words, cast(length(replace(text, chr(0), '')) as bigint) as clean_chars from {_RAW}")
def text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters and words of every record, and characters without U+0000."""
    return raw(spark, sf_dir, "text").select("id", text.char_count("text").alias("chars"), text.word_count("text").alias("words"), F.length(text.without_nul("text")).cast("long").alias("clean_chars"))


@query(f"select id, md5(replace(title, chr(0), '')) as title, md5(replace(text, chr(0), '')) as text from {_RAW}")
def nul_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "title", "text").select("id", F.md5(text.without_nul("title")).alias("title"), F.md5(text.without_nul("text")).alias("text"))


@query(f"select id, cast(length(text) as bigint) as chars from {_RAW} where length(text) > case regexp_extract(spider_name, '_([a-z]+)$', 1) when 'pt' then 200 when 'en' then 1000 else 500 end")
def min_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records longer than the bound of their kind of source."""
    rows = raw(spark, sf_dir, "text", "spider_name").withColumn("kind", F.regexp_extract("spider_name", "_([a-z]+)$", 1))
    return ingest.long_enough(rows, {"pt": 200, "en": 1000}, "kind", 500).select("id", text.char_count("text").alias("chars"))


@query(f"select id, md5(substr(text, 1, 4000)) as head, md5(case when length(text) > 4000 then upper(substr(text, 1, 10)) || substr(text, 4001) else upper(substr(text, 1, 10)) end) as whole, case when text is null or not regexp_matches(text, '[^{_W}]') then 'empty' else md5(substr(text, 1, 24000)) end as embedder from {_RAW}")
def prefix_recompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head a model is shown, and its answer put before the rest."""
    rows = raw(spark, sf_dir, "text")
    sent = text.embedder_input("text")
    return rows.select("id", F.md5(text.head("text", 4000)).alias("head"), F.md5(text.recompose(F.upper(text.head("text", 10)), "text")).alias("whole"), F.when(sent == "empty", sent).otherwise(F.md5(sent)).alias("embedder"))


@query(
    f"select id, md5({_STRIP}) as text, case when text is null then null else md5({_STRIP}) end as between_markers from {_RAW}"
)
def marker_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stripped text, and the same text found again between a start and an end marker."""
    rows = raw(spark, sf_dir, "text")
    marked = F.concat(F.lit("*** START OF THE BOOK x\ny ***"), "text", F.lit("\n*** End of the book\nlicence"))
    return rows.select("id", F.md5(text.strip("text")).alias("text"), F.md5(text.strip_markers(marked, r"\*\*\* START OF THE BOOK.*?\*\*\*", r"\*\*\* END OF THE BOOK")).alias("between_markers"))


@query(
    f"select id, coalesce(nullif(url, ''), 'generated_url_' || md5(id)) as url, coalesce(nullif(url, ''), nullif(title, ''), 'unknown') as source, case when contains(coalesce(spider_name, ''), '_pt') then '_pt' when contains(coalesce(spider_name, ''), 'man') then 'man' when contains(coalesce(spider_name, ''), '_en') then '_en' else 'unknown' end as kind, list_extract(string_split(coalesce(url, ''), '/'), -1) as base, replace(list_extract(string_split(coalesce(url, '') || '.parquet', '/'), -1), '.parquet', '.jsonl') as paired from {_RAW}"
)
def names_and_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls for all, source with fallbacks, the first name contained, base names and paired names."""
    url = F.coalesce("url", F.lit(""))
    return raw(spark, sf_dir, "url", "title", "spider_name").select(
        "id", text.url_or_generated("url", "id").alias("url"), text.source_of("url", "title").alias("source"), text.first_contained("spider_name", ["_pt", "man", "_en"]).alias("kind"),
        text.base_name(url).alias("base"), text.paired_name(F.concat(url, F.lit(".parquet"))).alias("paired"),
    )


def _langs(code: str) -> str:
    return "len(list_intersect(w, [" + ", ".join(f"'{x}'" for x in text.COMMON_WORDS[code].split()) + "]))"


@query(
    f"with t as (select id, text, list_distinct(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) w from {_RAW}), s as (select id, text, "
    + ", ".join(f"{_langs(c)} as {c}_" for c in text.COMMON_WORDS)
    + f" from t) select id, case when text is null or length({_STRIP}) < 10 or greatest("
    + ", ".join(f"{c}_" for c in text.COMMON_WORDS)
    + ") = 0 then 'unknown' "
    + " ".join(f"when {c}_ = greatest({', '.join(f'{x}_' for x in text.COMMON_WORDS)}) then '{c}'" for c in text.COMMON_WORDS)
    + " end as lang from s"
)
def language_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "text").select("id", text.language("text").alias("lang"))


@query(
    "select id, any_value(case when json_valid(metadata) and json_type(metadata) = 'OBJECT' then json_extract_string(metadata, '$.raw_id') end) as plain, any_value(case when json_valid(metadata) and json_type(metadata) = 'OBJECT' then json_extract_string(metadata, '$.raw_id') end) as fenced from qa_dataset group by id"
)
def fenced_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON answer, as it is and from within a fence; null where there is no JSON object."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("raw_id", T.StringType())])
    rows = table(spark, sf_dir, "qa_dataset").select("id", "metadata").dropDuplicates(["id"])
    fenced = F.concat(F.lit("Here it is:\n```json\n"), "metadata", F.lit("\n```\nDone."))
    return rows.select("id", jsons.structured("metadata", schema)["raw_id"].alias("plain"), jsons.structured(fenced, schema)["raw_id"].alias("fenced"))


@query(
    f"select id, 'Title: ' || nullif(title, '') as t, cast(length(text) as varchar) as n, nullif(concat_ws(' | ', 'Title: ' || nullif(title, ''), 'Domain: ' || nullif(language, ''), 'Topic: ' || nullif(spider_name, '')), '') as described from {_RAW}"
)
def metadata_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata written as JSON, read again, and what of it would be embedded."""
    rows = raw(spark, sf_dir, "title", "language", "spider_name", "text").withColumn("m", jsons.metadata(title="title", domain="language", topic="spider_name", n=F.length("text")))
    got = lambda n: jsons.field("m", n)
    return rows.select("id", jsons.labelled_text(Title=got("title")).alias("t"), got("n").alias("n"), jsons.labelled_text(Title=got("title"), Domain=got("domain"), Topic=got("topic")).alias("described"))


@query("select id, any_value(cast(len(embedding) as integer)) as size, any_value(round(list_sum(embedding), 6)) + 0.0 as total from embeddings_chunks where embedding is not null and len(embedding) > 0 group by id")
def vector_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors read from their text."""
    rows = table(spark, sf_dir, "embeddings_chunks").where("embedding is not null and size(embedding) > 0").select("id", "embedding").dropDuplicates(["id"])
    parsed = rows.select("id", vectors.parse(F.concat(F.lit("["), F.array_join(F.col("embedding").cast("array<string>"), ", "), F.lit("]"))).alias("v"))
    return parsed.select("id", F.size("v").alias("size"), (F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 6) + F.lit(0.0)).alias("total"))


_MESSAGES = ["429 Too Many Requests", "Quota exceeded per DAY", "ValidationError: field", "JSON is bad", "parsing failed", "read timeout", "rate limit", "prompt too large", "HTTP 400 bad token", "maximum context length", "connection reset", ""]


def _message() -> Column:
    out = F.lit(None).cast("string")
    for i, m in enumerate(_MESSAGES):
        out = F.when(F.col("event_id") % (len(_MESSAGES) + 1) == i, F.lit(m)).otherwise(out)
    return out


_HAS = lambda c, *parts: "(" + " or ".join(f"contains({c}, '{p}')" for p in parts) + ")"


@query(
    f"with m as (select event_id, case event_id % {len(_MESSAGES) + 1} "
    + " ".join(f"when {i} then '{m}'" for i, m in enumerate(_MESSAGES))
    + " end as message from events), n as (select event_id, coalesce(message, '') as m, lower(coalesce(message, '')) as l from m) select event_id, "
    + f"{_HAS('l', '429', 'quota', 'resource_exhausted')} as rate_limited, {_HAS('l', 'daily', 'day', 'user rate limit exceeded')} as daily_limited, "
    + f"({_HAS('m', 'ValidationError', 'JSON')} or {_HAS('l', 'parsing', 'timeout', 'limit')}) as retryable, ({_HAS('l', 'too many tokens', 'split into more batches')} or (contains(l, '400') and contains(l, 'token'))) as too_many_tokens, "
    + f"case when {_HAS('m', 'ValidationError', 'JSON')} or contains(l, 'parsing') then 'SCHEMA_MISMATCH' when {_HAS('l', 'too large', 'context_length', 'context length', '400')} then 'CONTEXT_EXCEEDED' else 'API_ERROR' end as class from n"
)
def error_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of error messages (made from event numbers)."""
    rows = table(spark, sf_dir, "events").select("event_id", _message().alias("m"))
    return rows.select("event_id", errors.rate_limited("m").alias("rate_limited"), errors.daily_limited("m").alias("daily_limited"), errors.retryable("m").alias("retryable"), errors.too_many_tokens("m").alias("too_many_tokens"), errors.error_class("m").alias("class"))


@query(f"select id, cast(i as integer) as chunk_index, md5(array_to_string(list_slice(w, i * 100 + 1, i * 100 + 100), ' ')) as chunk from (select id, regexp_extract_all(text, '[^{_W}]+') as w from {_RAW}) t, range(0, 1000) r(i) where i * 100 < len(w)")
def chunk_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 100 words."""
    return chunks.by_words(raw(spark, sf_dir, "text"), 100).select("id", "chunk_index", F.md5("chunk_text").alias("chunk"))


@query(f"select id, cast(i as integer) as part, md5(case when length(text) <= 1600 then text else substr(text, i * 1100 + 1, 1200) end) as chunk from (select id, text from {_RAW} where text is not null) t, range(0, 1000) r(i) where i = 0 or (length(text) > 1600 and i <= ceil((length(text) - 1200) / 1100.0))")
def chunk_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of 1,200 characters with 100 in common, of texts over 1,600 characters."""
    return raw(spark, sf_dir, "text").select("id", F.posexplode(chunks.overlapping("text", 1600, 1200, 100)).alias("part", "c")).select("id", "part", F.md5("c").alias("chunk"))


@query(f"select id, cast(i as integer) as chunk_index, md5(array_to_string(list_slice(w, i * 300 + 1, i * 300 + 300), '')) as chunk from (select id, regexp_extract_all(text, '[{_W}]*[^{_W}]+|[{_W}]+$') as w from {_RAW}) t, range(0, 1000) r(i) where i * 300 < len(w)")
def chunk_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 300 tokens of the default tokenizer; together they give the text."""
    from quern.providers import Offline

    return chunks.by_tokens(raw(spark, sf_dir, "text"), Offline().tokens, 300).select("id", "chunk_index", F.md5("chunk_text").alias("chunk"))


@query("select record_id, md5(string_agg(chr(10) || '--- FRAGMENTO ' || (chunk_index + 1) || ' ---' || chr(10) || t || chr(10), '' order by chunk_index, t)) as text from (select distinct record_id, chunk_index, substr(chunk_text, 1, 40) as t from embeddings_chunks where record_id is not null and chunk_index is not null) where t <> '' group by record_id")
def fragment_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heads of a record's pieces in order, each under its number."""
    rows = table(spark, sf_dir, "embeddings_chunks").where("record_id is not null and chunk_index is not null").select("record_id", "chunk_index", text.head("chunk_text", 40).alias("t")).distinct()
    return chunks.joined(rows, ["record_id"], "chunk_index", "t").select("record_id", F.md5("t").alias("text"))


@query("select source, array_to_string(list_sort(list_distinct(flatten(list(k)))), ',') as keywords from (select source, string_split(lower(model), '-') as k from qa_dataset where source is not null and model is not null) group by source")
def keyword_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "qa_dataset").where("source is not null and model is not null").select("source", F.split(F.lower("model"), "-").alias("keywords"))
    return chunks.keyword_union(rows, ["source"], "keywords").select("source", F.array_join("keywords", ",").alias("keywords"))


@query("select id, any_value(case lower(model) when 'granite-3b' then 'granite' when 'llama-8b' then 'llama' else model end) as model, any_value('Resumo: ' || coalesce(question, '') || ' / 3') as prompt from qa_dataset group by id")
def alias_and_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical model names and a filled-in prompt."""
    rows = table(spark, sf_dir, "qa_dataset").dropDuplicates(["id"])
    return rows.select("id", qa.canonical_model({"granite-3b": "granite", "llama-8b": "llama"}).alias("model"), text.render("Resumo: {abstract} / {count}", abstract="question", count=F.lit(3)).alias("prompt"))


_LINES = rf"list_filter(list_transform(string_split(replace(text, chr(0), ''), chr(10)), lambda x: regexp_replace(x, '^[{_W}]+|[{_W}]+$', '', 'g')), lambda x: x <> '')"


@query(f"select id, coalesce(nullif(regexp_replace(title, '^[{_W}]+|[{_W}]+$', '', 'g'), ''), 'untitled') as title, md5(array_to_string({_LINES}, ' ')) as text, 'https://a.example/doc/' || id as link from {_RAW} where text is not null and title is not null")
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, text and links of pages made from the records, with scripts, unclosed paragraphs and foreign links."""
    rows = raw(spark, sf_dir, "title", "text").where("text is not null and title is not null")
    escape = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    paragraphs = F.replace(escape(text.without_nul("text")), F.lit("\n"), F.lit("<p>"))
    html = F.concat(F.lit("<html><body><script>var a = '</p><p>no';</script><h1>"), escape(F.col("title")), F.lit("</h1><div><p>"), paragraphs, F.lit("</div><a href='/doc/"), "id", F.lit("'>x</a><a href='/doc/"), "id", F.lit("'>x</a><a href='https://own.example/z'>y</a></body>"))
    pages = rows.select("id", markup.page(html).alias("p"))
    return pages.select("id", "p.title", F.md5("p.text").alias("text"), F.array_join(markup.links("p", F.lit("https://a.example/list"), "/", "own.example"), " ").alias("link"))


@query(f"select id, md5(id) as title, 'https://a.example/' || id || '.pdf' as link from {_RAW}")
def atom_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with a PDF link of feeds made from the ids."""
    rows = raw(spark, sf_dir)
    feed = F.concat(F.lit("<feed><entry><title>"), F.md5("id"), F.lit("</title><link type='application/pdf' href='https://a.example/"), "id", F.lit(".pdf'/></entry><entry><title>no</title><link type='text/html' href='x'/></entry></feed>"))
    return markup.atom_entries(rows.select("id", feed.alias("xml")), "xml")


@query(f"select id, title, md5({_STRIP}) as extract from {_RAW} where title <> '' and length({_STRIP}) > 200")
def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of wiki answers made from the records, with a title and more than 200 characters."""
    rows = raw(spark, sf_dir, "title", "text")
    page = F.map_from_arrays(F.array("id"), F.array(F.struct("title", F.col("text").alias("extract"))))
    answer = F.to_json(F.struct(F.struct(page.alias("pages")).alias("query")))
    return markup.wiki_pages(rows.select("id", answer.alias("a")), "a").select("id", "title", F.md5("extract").alias("extract"))

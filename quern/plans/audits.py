"""Queries on the audit of question and answer rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.vectors import cosine
from quern.operators import audit
from quern.plans.registry import query
from quern.runtime import table, written

_COSINE = "case when len({a}) > 0 and len({a}) = len({b}) then case when list_dot_product({a}, {a}) > 0 and list_dot_product({b}, {b}) > 0 then list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))) else 0 end end"
_PHANTOM = r"(^|[^\pL\pN_])(" + "|".join(audit.PHRASES) + r")($|[^\pL\pN_])"
_PHRASE_LIST = "[" + ", ".join(f"'{p}'" for p in audit.PHRASES) + "]"
#: The phrases found in ``question`` or ``answer``, each by its own constant pattern.
_FOUND = (
    "list_filter(["
    + ", ".join(rf"case when regexp_matches(coalesce(question, '') || chr(10) || coalesce(answer, ''), '(^|[^\pL\pN_]){p}($|[^\pL\pN_])', 'i') then '{p}' end" for p in audit.PHRASES)
    + "], lambda x: x is not null)"
)
_QA, _QC = _COSINE.format(a="r.q", b="r.a"), _COSINE.format(a="r.a", b="c.embedding")
_FIELD = "any_value(case when json_valid(metadata) then json_extract_string(metadata, '$.{0}') end)"
#: Each row once with its scores and flags.
_FLAGS = f"""
with qa as (
    select id, any_value(question) question, any_value(answer) answer, any_value(embedding) q, nullif({_FIELD.format("corpus_id")}, '') source, {_FIELD.format("raw_id")} raw
    from qa_dataset where id is not null group by id),
own as (
    select record_id, arg_min(embedding, id) a from embeddings_chunks where table_name = 'qa_dataset' and chunk_index = 0 group by record_id),
rows_ as (select qa.*, own.a from qa left join own on own.record_id = qa.id),
ground as (
    select r.id, max({_QC}) g
    from rows_ r join embeddings_chunks c on c.record_id = r.raw and c.table_name is distinct from 'qa_dataset'
    where r.source is not null group by r.id),
flags as (
    select r.id, r.question, r.answer, r.source, {_QA} as c, g,
        coalesce(regexp_matches(question, '{_PHANTOM}', 'i'), false) or coalesce(regexp_matches(answer, '{_PHANTOM}', 'i'), false) as context_reference,
        coalesce({_QA} < {audit.MIN_QA}, false) as semantic_mismatch,
        source is null or coalesce(g < {audit.MIN_GROUND}, false) as ungrounded_answer,
        source is null as source_not_in_corpus
    from rows_ r left join ground on ground.id = r.id)
"""


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "qa_dataset"), table(spark, sf_dir, "embeddings_chunks")


@query(
    f"""{_FLAGS}
select flag, cast(count(*) filter (hit) as bigint) as rows, round(count(*) filter (hit) * 100.0 / nullif(count(*), 0), 4) as share
from (select id, unnest(['context_reference', 'semantic_mismatch', 'ungrounded_answer', 'source_not_in_corpus']) flag,
    unnest([context_reference, semantic_mismatch, ungrounded_answer, source_not_in_corpus]) hit from flags)
group by flag"""
)
def qa_audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows have each flag."""
    return audit.audit_report(*_tables(spark, sf_dir))


@query(
    f"""{_FLAGS}
select id, array_to_string(list_filter([case when context_reference then 'context_reference' end, case when semantic_mismatch then 'semantic_mismatch' end, case when ungrounded_answer then 'ungrounded_answer' end,
    case when source_not_in_corpus then 'source_not_in_corpus' end], lambda x: x is not null), ',') as flags,
  array_to_string(list_concat({_FOUND},
    list_filter([case when c < {audit.MIN_QA} then printf('cosine_qa:%.4f', c) end, case when source is null then 'source_not_in_corpus' when g < {audit.MIN_GROUND} then printf('grounding_score:%.4f', g) end], lambda x: x is not null)), ';') as triggers,
  round(c, 6) + 0.0 as cosine_qa, round(g, 6) + 0.0 as grounding,
  case when context_reference then '{audit.REPLIES["context_reference"]}' when ungrounded_answer then '{audit.REPLIES["ungrounded_answer"]}' when semantic_mismatch then '{audit.REPLIES["semantic_mismatch"]}' end as reply
from flags"""
)
def qa_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags, triggers, scores and reply of every row."""
    rows = audit.judged(audit.scored(*_tables(spark, sf_dir)))
    four = lambda c: F.round(c, 6) + F.lit(0.0)
    return rows.select("id", F.array_join("audit_flags", ",").alias("flags"), F.array_join("audit_triggers", ";").alias("triggers"), four("cosine_qa").alias("cosine_qa"), four("grounding_score").alias("grounding"), F.col("resposta_desejada").alias("reply"))


@query(
    f"""{_FLAGS}, bad as (select id from flags where context_reference or semantic_mismatch or ungrounded_answer)
select 'qa_dataset' as name, count(*) as rows from qa_dataset where id is null or id not in (select id from bad)
union all select 'qa_dataset_quarantine', count(*) from bad
union all select 'embeddings_chunks', count(*) from embeddings_chunks where not coalesce(table_name = 'qa_dataset' and record_id in (select id from bad), false)"""
)
def qa_quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table after the flagged ones moved to quarantine."""
    questions, chunks = _tables(spark, sf_dir)
    moved = audit.quarantine(questions, chunks, written(audit.judged(audit.scored(questions, chunks)), "audit"))
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in moved.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    f"""with p as (select list_extract({_PHRASE_LIST}, cast(n % {len(audit.PHRASES)} as integer) + 1) as phrase, n, id, q from (
  select id, any_value(question) q, cast('0x' || substr(md5(id), 1, 4) as integer) as n from qa_dataset where id is not null group by id)),
rows_ as (select id, case n % 3 when 0 then upper(phrase) || ' x' when 1 then 'é' || phrase else coalesce(q, '') end as question, case n % 2 when 0 then 'y, ' || phrase || '.' else '' end as answer from p)
select id, array_to_string({_FOUND}, ';') as triggers from rows_"""
)
def phantom_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases put into questions and answers: upper case, behind a letter, before marks."""
    rows = table(spark, sf_dir, "qa_dataset").where("id is not null").dropDuplicates(["id"])
    rows = rows.withColumn("n", F.conv(F.substring(F.md5("id"), 1, 4), 16, 10).cast("int"))
    rows = rows.withColumn("phrase", F.element_at(F.array(*map(F.lit, audit.PHRASES)), (F.col("n") % len(audit.PHRASES) + 1).cast("int")))
    question = F.when(F.col("n") % 3 == 0, F.concat(F.upper("phrase"), F.lit(" x"))).when(F.col("n") % 3 == 1, F.concat(F.lit("é"), "phrase")).otherwise(F.coalesce("question", F.lit("")))
    answer = F.when(F.col("n") % 2 == 0, F.concat(F.lit("y, "), "phrase", F.lit("."))).otherwise(F.lit(""))
    return rows.select("id", question.alias("q"), answer.alias("a")).select("id", F.array_join(audit.phantom_triggers("q", "a"), ";").alias("triggers"))


@query(
    f"""with v as (select id, any_value(record_id) record_id, any_value(embedding) e from embeddings_chunks group by id),
f as (select record_id, arg_min(e, id) first_ from v where e is not null group by record_id)
select v.id, round({_COSINE.format(a="v.e", b="f.first_")}, 6) + 0.0 as cosine from v join f using (record_id)"""
)
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of every piece with the first piece of its record; zero, short and empty vectors included."""
    rows = table(spark, sf_dir, "embeddings_chunks").select("id", "record_id", "embedding").dropDuplicates(["id"])
    first = rows.where("embedding is not null").groupBy("record_id").agg(F.min_by("embedding", "id").alias("first_"))
    return rows.join(first, "record_id").select("id", (F.round(cosine("embedding", "first_"), 6) + F.lit(0.0)).alias("cosine"))


@query(f"{_FLAGS} select id, round(g, 6) + 0.0 as grounding from flags where source is not null")
def grounding_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best similarity of each answer with its source's pieces."""
    rows = audit.scored(*_tables(spark, sf_dir)).where("source_id is not null")
    return rows.select("id", (F.round("grounding_score", 6) + F.lit(0.0)).alias("grounding"))


@query(
    r"""with w as (select id, list_distinct(regexp_extract_all(lower(coalesce(any_value(question), '')), '[\pL\pN]+')) q, list_distinct(regexp_extract_all(lower(coalesce(any_value(answer), '')), '[\pL\pN]+')) a from qa_dataset where id is not null group by id)
select id, case when len(q) > 0 then round(len(list_intersect(q, a)) / len(q), 6) else 0 end as score, case when len(q) > 0 then len(list_intersect(q, a)) / len(q) < 0.3 else true end as risk from w"""
)
def nli_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entailment by the default provider, and its flag."""
    rows = table(spark, sf_dir, "qa_dataset").where("id is not null").dropDuplicates(["id"])
    return audit.entailment(rows, "offline").select("id", F.round("nli_score", 6).alias("score"), (F.col("nli_score") < audit.MIN_ENTAIL).alias("risk"))

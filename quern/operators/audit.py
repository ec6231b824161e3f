"""Audit of question and answer rows in four layers, and what follows from it.

Layers: phrases that refer to a missing document, entailment of the answer by the question (a provider), similarity of
question and answer, grounding of the answer in its source's chunks. An answer's vector is the chunk 0 stored for the
row under ``qa_dataset`` (the smallest id of several); the source's chunks are those of ``source_id``.

Defined cases: an id delivered twice counts once; a row without a source is ungrounded and ``source_not_in_corpus``; a
source without chunks has no grounding score and no flag; what is missing a vector is not judged by similarity.
Bounds are strict and meet unrounded scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import jsons
from quern.functions.vectors import cosine, labelled
from quern.operators import writes
from quern.providers import provider

FLAGS = ["context_reference", "hallucination_risk", "semantic_mismatch", "ungrounded_answer", "source_not_in_corpus"]
#: The flag whose reply a row gets: the first it has.
PRIORITY = ["context_reference", "ungrounded_answer", "hallucination_risk", "semantic_mismatch"]
MIN_ENTAIL, MIN_QA, MIN_GROUND = 0.30, 0.50, 0.55
#: Phrases that refer to a document the reader does not have.
PHRASES = [
    "no artigo", "no texto", "no documento", "segundo o autor", "conforme o texto", "baseado no texto", "de acordo com o texto",
    "mencionado no texto", "citado no texto", "segundo a passagem", "passagem fornecida", "artigo acima", "texto acima", "documento acima",
    "informações fornecidas", "baseado no artigo", "de acordo com o artigo", "mencionado no artigo", "conforme o artigo",
    "o texto não menciona", "o artigo não menciona", "baseado no documento", "de acordo com o documento", "conforme o documento",
    "mencionado no documento", "in the article", "in the text", "in the document", "according to the text", "based on the text",
    "mentioned in the text", "the text does not", "the article does not", "according to the author", "provided passage", "passage above",
    "text above", "article above", "document above", "provided information", "based on the article", "according to the article",
    "mentioned in the article",
]
PHANTOM = r"(?iu)(^|[^\pL\pN_])(" + "|".join(PHRASES) + r")($|[^\pL\pN_])"
#: Replies by flag, in our own words.
REPLIES = {
    "context_reference": "O documento citado não está comigo. Pode enviar o trecho?",
    "ungrounded_answer": "Para responder preciso do material de origem. Pode fornecê-lo?",
    "hallucination_risk": "Falta contexto para uma resposta segura. Pode dar mais detalhes?",
    "semantic_mismatch": "Não ficou claro o que se pergunta. Pode reformular?",
}


def phantom_triggers(question: str | Column, answer: str | Column) -> Column:
    """The phrases found in either text, in the order of :data:`PHRASES`.

    One pass over the whole pattern decides whether single phrases are looked for at all.
    """
    both = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (question, answer)]
    hit = lambda p: both[0].rlike(p) | both[1].rlike(p)
    each = F.array_compact(F.array(*[F.when(hit(rf"(?iu)(^|[^\pL\pN_]){p}($|[^\pL\pN_])"), F.lit(p)) for p in PHRASES]))
    return F.when(hit(PHANTOM), each).otherwise(F.array().cast("array<string>"))


def entailment(rows: DataFrame, name: str) -> DataFrame:
    """The rows with ``nli_score``: how far a provider sees the answer follow from the question."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = provider(name)
        for q, a in batches:
            yield pd.Series(own.entail(list(zip(q.fillna(""), a.fillna("")))), dtype="float64")

    return rows.withColumn("nli_score", score("question", "answer"))


def scored(qa: DataFrame, chunks: DataFrame, entail: str | None = None) -> DataFrame:
    """Every row once, with its triggers by phrase (``phantom``) and its scores (null where it has none)."""
    rows = qa.where("id is not null").dropDuplicates(["id"]).withColumns({"source_id": F.nullif(jsons.field("metadata", "corpus_id"), F.lit("")), "_raw": jsons.field("metadata", "raw_id")})
    own = chunks.where("table_name = 'qa_dataset' and chunk_index = 0").select(F.col("record_id").alias("id"), F.col("id").alias("chunk"), "embedding").groupBy("id").agg(F.min_by("embedding", "chunk").alias("_answer"))
    rows = rows.join(own, "id", "left")
    # The table that corpus_id points to is not supplied: a source's chunks are those stored for raw_id.
    others = chunks.where("table_name is null or table_name <> 'qa_dataset'").select(F.col("record_id").alias("_raw"), F.col("embedding").alias("_chunk"))
    ground = rows.where("source_id is not null").select("id", "_raw", "_answer").join(others, "_raw").groupBy("id").agg(F.max(cosine("_answer", "_chunk")).alias("grounding_score"))
    rows = rows.join(ground, "id", "left").withColumns({"phantom": phantom_triggers("question", "answer"), "cosine_qa": cosine("embedding", "_answer")})
    return entailment(rows, entail) if entail else rows.withColumn("nli_score", F.lit(None).cast("double"))


def judged(rows: DataFrame) -> DataFrame:
    """:func:`scored` rows with ``audit_flags`` (in the order of :data:`FLAGS`), ``audit_triggers``, ``audit_scores`` and ``resposta_desejada``."""
    no_source = F.col("source_id").isNull()
    found = {
        "context_reference": F.size("phantom") > 0,
        "hallucination_risk": F.col("nli_score") < MIN_ENTAIL,
        "semantic_mismatch": F.col("cosine_qa") < MIN_QA,
        "ungrounded_answer": no_source | (F.col("grounding_score") < MIN_GROUND),
        "source_not_in_corpus": no_source,
    }
    flags = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in found.items()]))
    score = lambda c, least: F.when(F.col(c) < least, labelled(c, F.col(c)))
    marks = F.array_compact(F.array(score("nli_score", MIN_ENTAIL), score("cosine_qa", MIN_QA), F.when(no_source, F.lit("source_not_in_corpus")).otherwise(score("grounding_score", MIN_GROUND))))
    out = rows.withColumns({"audit_flags": flags, "audit_triggers": F.concat("phantom", marks), "audit_scores": jsons.metadata(nli_score="nli_score", cosine_qa="cosine_qa", grounding_score="grounding_score")})
    reply = F.coalesce(*[F.when(F.array_contains("audit_flags", f), F.lit(REPLIES[f])) for f in PRIORITY], F.lit(REPLIES["hallucination_risk"]))
    return out.withColumn("resposta_desejada", F.when(F.size("audit_flags") > 0, reply))


def audit_flags(qa: DataFrame, chunks: DataFrame, entail: str | None = None) -> DataFrame:
    """(id, flag) of every flag of every row; the flag is null for rows without any."""
    return judged(scored(qa, chunks, entail)).select("id", F.explode_outer("audit_flags").alias("flag"))


def reported(rows: DataFrame, entailed: bool) -> DataFrame:
    """(flag, rows, share) of :func:`judged` rows: how many have each flag; flags nobody has stand with 0."""
    flags = [f for f in FLAGS if entailed or f != "hallucination_risk"]
    counts = rows.agg(F.count("*").alias("total"), *[F.count_if(F.array_contains("audit_flags", f)).alias(f) for f in flags])
    each = F.inline(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("rows")) for f in flags]))
    return counts.select("total", each).select("flag", "rows", F.when(F.col("total") > 0, F.round(F.col("rows") * 100.0 / F.col("total"), 4)).alias("share"))


def audit_report(qa: DataFrame, chunks: DataFrame, entail: str | None = None) -> DataFrame:
    """The report over all rows."""
    return reported(judged(scored(qa, chunks, entail)), bool(entail))


def quarantine(qa: DataFrame, chunks: DataFrame, rows: DataFrame) -> dict[str, DataFrame]:
    """The states after flagged rows moved: the rows for quarantine, the questions and the chunks left.

    ``rows``: :func:`judged`, written or cached, since three writes use it. The quarantine's ``embedding`` is the answer's.
    """
    flagged = rows.where(F.size("audit_flags") > 0)
    moved = flagged.select(
        "id", "question", "reasoning", "answer", "model", "source", F.col("_answer").alias("embedding"), "metadata", "audit_flags", "audit_scores", "audit_triggers", "resposta_desejada", F.current_timestamp().alias("audited_at")
    )
    ids = flagged.select("id")
    return {
        "qa_dataset_quarantine": moved,
        "qa_dataset": writes.delete(qa, ids, "id"),
        "embeddings_chunks": writes.delete(chunks, ids, "record_id", "id", F.col("table_name") == "qa_dataset"),
    }

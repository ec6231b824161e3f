from pyspark.sql import functions as F

from quern.operators import audit


def test_missing_vectors_and_sources(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    qa = spark.createDataFrame(
        [
            ("a", "q", "No texto, x", one, '{"corpus_id": "c", "raw_id": "r"}'),
            ("b", "q", "contexto", None, None),
            ("c", "q", None, one, '{"corpus_id": "c", "raw_id": "s"}'),
            ("d", "q", "INFORMAÇÕES FORNECIDAS", one, '{"corpus_id": "c", "raw_id": "t"}'),
        ],
        "id string, question string, answer string, embedding array<double>, metadata string",
    )
    chunks = spark.createDataFrame(
        [("1", "a", "qa_dataset", 0, one), ("2", "r", "raw_corpus", 0, one), ("3", "c", "qa_dataset", 0, two), ("4", "s", "raw_corpus", 0, one), ("5", "d", "qa_dataset", 1, two)],
        "id string, record_id string, table_name string, chunk_index int, embedding array<double>",
    )
    got = sorted(map(tuple, audit.audit_flags(qa, chunks).collect()))
    assert got == [
        ("a", "context_reference"), ("b", "source_not_in_corpus"), ("b", "ungrounded_answer"), ("c", "semantic_mismatch"), ("c", "ungrounded_answer"), ("d", "context_reference"),
    ]


def test_triggers_reply_and_quarantine(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    schema = "id string, question string, reasoning string, answer string, model string, source string, embedding array<double>, metadata string"
    meta = '{"corpus_id": "c", "raw_id": "r"}'
    qa = spark.createDataFrame([("a", "No texto acima?", "", "x", "m", "s", one, meta), ("b", "fine words", "", "fine words", "m", "s", one, meta), ("c", "q", "", "z", "m", "s", one, None)], schema)
    chunks = spark.createDataFrame(
        [("1", "a", "qa_dataset", 0, one), ("2", "b", "qa_dataset", 0, one), ("3", "r", "raw_corpus", 0, one), ("4", "a", "raw_corpus", 0, two), ("5", "c", "qa_dataset", 0, two)],
        "id string, record_id string, table_name string, chunk_index int, embedding array<double>",
    )
    rows = audit.judged(audit.scored(qa, chunks, "offline")).cache()
    got = {r.id: r for r in rows.collect()}
    assert got["a"].audit_triggers == ["no texto", "texto acima", "nli_score:0.0000"] and got["a"].audit_flags == ["context_reference", "hallucination_risk"]
    assert got["a"].resposta_desejada == audit.REPLIES["context_reference"] and got["b"].audit_flags == [] and got["b"].resposta_desejada is None
    assert got["c"].audit_triggers == ["nli_score:0.0000", "cosine_qa:0.0000", "source_not_in_corpus"] and got["c"].resposta_desejada == audit.REPLIES["ungrounded_answer"]
    moved = audit.quarantine(qa, chunks, rows)
    assert sorted(r.id for r in moved["qa_dataset_quarantine"].collect()) == ["a", "c"]
    assert [r.id for r in moved["qa_dataset"].collect()] == ["b"] and sorted(r.id for r in moved["embeddings_chunks"].collect()) == ["2", "3", "4"]
    assert {r.flag: r.rows for r in audit.audit_report(qa, chunks, "offline").collect()}["hallucination_risk"] == 2
    assert audit.audit_report(qa.limit(0), chunks).where(F.col("share").isNull()).count() == 4


def test_bounds_are_strict(spark):
    from math import sqrt

    qa = spark.createDataFrame([("a", "q", "x", [1.0, 0.0], None), ("b", "q", "x", [1.0, 0.0], None)], "id string, question string, answer string, embedding array<double>, metadata string")
    vectors = [("1", "a", "qa_dataset", 0, [0.5, sqrt(0.75)]), ("2", "b", "qa_dataset", 0, [0.4999, sqrt(1 - 0.4999**2)])]
    chunks = spark.createDataFrame(vectors, "id string, record_id string, table_name string, chunk_index int, embedding array<double>")
    flags = {r.id: r.audit_flags for r in audit.judged(audit.scored(qa, chunks)).collect()}
    assert "semantic_mismatch" not in flags["a"] and "semantic_mismatch" in flags["b"]

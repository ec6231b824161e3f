import pytest
from pyspark.sql import functions as F

from quern.operators import ingest, writes
from quern.runtime import broadcast_if_small
from quern.sources import schemas
from quern.sources.files import Store, json_lines, listed, raw_files, write_json_lines


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "u"), (2, None)], "id int, url string")
    new = spark.createDataFrame([(5, "v"), (4, "v"), (3, "u"), (6, None), (7, None)], "id int, url string")
    assert rows(writes.insert_ignore(target, new, "url", "id"), "id") == [(4, "v"), (6, None), (7, None)]
    assert rows(writes.insert_ignore(target, new.limit(0), "url", "id"), "id") == []


def test_upsert_and_replace(spark):
    old = spark.createDataFrame([("a", "m", 1), ("b", "n", None)], "provider string, model_id string, last_seen int")
    new = spark.createDataFrame([("a", "m", 5), ("a", "m", 3), ("c", "o", 2)], "provider string, model_id string, last_seen int")
    assert rows(writes.upsert(old, new, ["provider", "model_id"], "last_seen"), "provider") == [("a", "m", 5), ("b", "n", None), ("c", "o", 2)]
    chunks = spark.createDataFrame([("t", "r", 0), ("t", "r", 1), ("u", "r", 0)], "table_name string, record_id string, chunk_index int")
    fresh = spark.createDataFrame([("t", "r", 9)], chunks.schema)
    assert rows(writes.replace_records(chunks, fresh, ["table_name", "record_id"]), "table_name") == [("t", "r", 9), ("u", "r", 0)]


def test_updates_flags_and_deletes(spark):
    target = spark.createDataFrame([(1, 1.0, False), (2, None, None), (3, 3.0, True)], "id int, v double, done boolean")
    values = spark.createDataFrame([(1, None), (2, 2.0)], "id int, v double")
    assert rows(writes.update(target, values, "id", "v"), "id") == [(1, 1.0, False), (2, 2.0, None), (3, 3.0, True)]
    done = writes.set_flag(target, spark.createDataFrame([(1,), (1,)], "id int"), "id", "done")
    assert [r[2] for r in rows(done, "id")] == [True, None, True]
    gone = spark.createDataFrame([(1,), (3,)], "other int")
    assert [r[0] for r in rows(writes.delete(target, gone, "id", "other", F.col("v") < 2), "id")] == [2, 3]


def test_store_publishes_all_or_none(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert not store.exists("available_models") and store.read("available_models").count() == 0
    store.ensure("embeddings_chunks")
    assert store.exists("embeddings_chunks") and store.read("embeddings_chunks").count() == 0
    chunk = spark.createDataFrame([("c", "r", "odd name", 0, "x", [1.0], None)], schemas.CHUNKS)
    model = spark.createDataFrame([("p", "m", None)], schemas.MODELS)
    store.publish({"embeddings_chunks": chunk, "available_models": model})
    again = Store(spark, str(tmp_path / "store"))
    assert tuple(again.read("embeddings_chunks").first()) == ("c", "r", "odd name", 0, "x", [1.0], None)
    with pytest.raises(Exception):
        again.publish({"available_models": model.limit(0), "embeddings_chunks": chunk.withColumn("chunk_index", F.raise_error(F.lit("broken")))})
    assert again.read("available_models").count() == 1


def test_tolerant_files(spark, tmp_path):
    folder = str(tmp_path / "raw")
    spark.createDataFrame([("two words",), (None,)], "text string").write.parquet(folder)
    got = raw_files(spark, folder)
    assert sorted((r.title, r.language, r.char_count, r.word_count) for r in got.collect() if r.text) == [("", "pt", 9, 2)]
    assert listed(spark, folder, ".parquet").count() >= 1
    other = str(tmp_path / "other")
    spark.createDataFrame([(1,)], "id int").write.parquet(other)
    with pytest.raises(schemas.MissingColumn):
        raw_files(spark, other)


def test_json_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"question": "é", "answer": null}\n\n{"question": "b", "answer": "c", "model": null}\n', encoding="utf-8")
    got = json_lines(spark, schemas.QA_LINE, str(path), defaults={"model": "unknown", "reasoning": ""})
    assert rows(got.select("question", "reasoning", "answer", "model"), "question") == [("b", "", "c", None), ("é", "", None, "unknown")]
    write_json_lines(got, str(tmp_path / "out"), "question", "answer")
    assert "é" in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json"))
    path.write_text("{bad\n", encoding="utf-8")
    with pytest.raises(Exception):
        json_lines(spark, schemas.QA_LINE, str(path)).collect()


def test_backfill_links_by_url_and_falls_back(spark):
    files = spark.createDataFrame(
        [("w_pt.parquet", "T\x00", "x" * 3, "u1"), ("w_pt.parquet", "U", "y", "u2"), ("w_pt.parquet", "V", "z", None), ("n.parquet", "W", "q", "u9")], "file string, title string, text string, url string"
    ).withColumns({"language": F.lit("pt"), "extracted_at": F.lit(None).cast("timestamp"), "char_count": F.length("text"), "word_count": F.lit(1)})
    raw = ingest.raw_rows(files, ["z_pt", "w_pt"], spark.createDataFrame([("w_pt.parquet",)], "file string"))
    got = {r.title: r for r in raw.collect()}
    assert set(got) == {"T", "U", "V", "W"} and got["T"].spider_name == "w_pt" and got["W"].spider_name == "unknown"
    assert got["T"].processed_qa and not got["W"].processed_qa and got["V"].url.startswith("generated_url_")
    assert {r.id for r in ingest.raw_rows(files, []).collect()} == {r.id for r in raw.collect()}
    assert ingest.corpus_rows(raw).where(F.get_json_object("metadata", "$.raw_id") == got["T"].id).count() == 1
    corpus = spark.createDataFrame([("f", 1, "u1", "a"), ("f", 2, "u2", "b"), ("f", 3, "u1", "c")], "file string, position int, url string, id string")
    qa = spark.createDataFrame([(1, "f", "u2"), (2, "f", "u1"), (3, "f", "none"), (4, "g", "u1")], "q int, file string, source string")
    assert rows(ingest.linked_questions(qa, corpus).select("q", "corpus_id", "matched"), "q") == [(1, "b", True), (2, "c", True), (3, "c", False), (4, None, False)]


def test_pending_and_topics(spark):
    raw = spark.createDataFrame([("a/1.parquet",), ("a/2.parquet",), ("a/3.parquet",)], "path string")
    done = spark.createDataFrame([("b/2.jsonl",), ("c/2.jsonl",)], "path string")
    assert [rows(ingest.pending_files(raw, done, n), "path") for n in (None, 0, 1)] == [[("a/1.parquet",), ("a/3.parquet",)]] * 2 + [[("a/1.parquet",)]]
    assert ingest.paired_files(raw, done).where("has_qa").count() == 1
    topics = spark.createDataFrame([(" a ",), ("a",), ("b",), ("  ",), (None,)], "topic string")
    added, counts = ingest.new_topics(topics, spark.createDataFrame([("b",)], "topic string"))
    assert rows(added, "topic") == [("a",)] and tuple(counts.first()) == (1, 2)


def test_broadcast_needs_rows_and_bytes(spark):
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 1000))
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, rows=99)) and not hinted(broadcast_if_small(df, size=50_000))

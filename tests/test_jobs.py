import json

from pyspark.sql import functions as F

from quern import jobs
from quern.sources.files import Store

LONG = "Montanhas antigas guardam segredos profundos desde 1900. As aldeias vizinhas conservam tradições longas e curiosas. " * 3


def test_from_files_to_quarantine(spark, tmp_path):
    raw, qa, queues = tmp_path / "raw", tmp_path / "qa", str(tmp_path / "queues")
    for d in (raw, qa):
        d.mkdir()
    one = spark.createDataFrame([("T1", LONG, "https://a.example/1"), ("T2", LONG.upper(), "https://a.example/2"), ("T3", LONG, "https://a.example/1"), ("T4", "x", "")], "title string, text string, url string").coalesce(1)
    two = spark.createDataFrame([("U1", LONG + "novo", "https://b.example/1"), ("U2", "curto", None)], "title string, text string, url string").coalesce(1)
    one.toPandas().to_parquet(raw / "wiki_pt_1.parquet")
    two.toPandas().to_parquet(raw / "arq_2.parquet")
    lines = [{"question": "q1", "answer": "a1", "source": "https://a.example/2"}, {"question": "q2", "answer": "no texto acima", "source": "nowhere"}]
    (qa / "wiki_pt_1.jsonl").write_text("\n\n".join(map(json.dumps, lines)), encoding="utf-8")
    store = Store(spark, str(tmp_path / "store"))

    got = {r.file: (r.raw, r.corpus, r.qa) for r in jobs.backfill(store, str(raw), str(qa), ["wiki_pt"], queues=queues).collect()}
    assert got == {"wiki_pt_1.parquet": (3, 3, 2), "arq_2.parquet": (2, 0, 0)}
    assert jobs.backfill(store, str(raw), str(qa), ["wiki_pt"]).collect() == []
    records = {r.title: r for r in store.read("raw_corpus").collect()}
    assert set(records) == {"T1", "T2", "T4", "U1", "U2"} and records["T1"].spider_name == "wiki_pt" and records["U1"].spider_name == "unknown"
    assert records["T1"].processed_qa and not records["U1"].processed_qa
    ids = {r.title: r.id for r in store.read("corpus").collect()}
    link = {r.question: json.loads(r.metadata)["corpus_id"] for r in store.read("qa_dataset").collect()}
    assert link == {"q1": ids["T2"], "q2": ids["T1"]}
    assert spark.read.json(f"{queues}/embed").count() == 5 and spark.read.json(f"{queues}/clean").count() == 2

    assert jobs.clean(store, queues=queues) == {"cleaned": 1, "processed": 1} and jobs.clean(store) == {"cleaned": 0, "processed": 0}
    assert store.read("raw_corpus").where("not processed_clean").count() == 0 and store.read("corpus").count() == 4
    n = jobs.embed(store, "corpus", size=10)
    assert n > 4 and jobs.embed(store, "corpus", size=10) == n and store.read("embeddings_chunks").count() == n
    assert store.read("corpus").where("embedding is not null").count() == 4
    made = jobs.generate(store)
    assert made == 3 and jobs.generate(store) == 0
    assert store.read("raw_corpus").where(~F.coalesce("processed_qa", F.lit(False)) & F.col("processed_clean")).count() == 0
    assert store.read("embeddings_chunks").where("table_name = 'qa_dataset'").count() == made

    report = {r.flag: r.rows for r in jobs.audit(store).collect()}
    assert report["context_reference"] == 1 and store.read("qa_dataset_quarantine").count() >= 1
    total = store.read("qa_dataset").count() + store.read("qa_dataset_quarantine").count()
    assert total == 5 and "q2" in {r.question for r in store.read("qa_dataset_quarantine").collect()}
    held = store.read("qa_dataset_quarantine").count()
    jobs.audit(store)
    assert store.read("qa_dataset_quarantine").count() == held
    assert jobs.sync_models(store, {"p": ["m", "n"]}) == 2 and jobs.sync_models(store, {"p": ["m"], "q": ["o"]}) == 3

from quern.sources import schemas
from quern.streaming import jobs


def test_a_second_run_brings_nothing_new(spark, tmp_path):
    queue, out, mark = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "mark")
    spark.createDataFrame([("a",), ("b",), (None,), ("",)], "id string").write.json(queue)
    seen = []

    def work(rows, number):
        seen.extend(r.id for r in rows.collect())
        jobs.fan_out(rows, {"x": (out, ["id"])}, number)

    for _ in range(2):
        jobs.consume(jobs.queue(spark, queue, schemas.CLEAN_TASK), work, mark, str(tmp_path / "bad")).awaitTermination()
    assert sorted(seen) == ["a", "b"] and spark.read.json(out).count() == 2
    assert spark.read.schema("id string, batch int").json(str(tmp_path / "bad")).count() == 2
    jobs.push(spark.createDataFrame([("c",)], "id string"), queue)
    jobs.consume(jobs.queue(spark, queue, schemas.CLEAN_TASK), work, mark).awaitTermination()
    assert sorted(seen) == ["a", "b", "c"]


def test_distinct_rows_over_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    run = lambda: jobs.to_table(jobs.distinct_rows(spark.readStream.schema("k string").json(folder), ["k"]), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    jobs.push(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), folder)
    run()
    jobs.push(spark.createDataFrame([("b",), ("c",)], "k string"), folder)
    run()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "b", "c"]


def test_unseen(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "url string")
    assert [r.url for r in jobs.unseen(rows, spark.createDataFrame([("a",)], "url string"), "url").collect()] == ["b"]

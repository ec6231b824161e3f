import pytest

from quern import providers
from quern.operators import clean, embedding, models, qa
from quern.providers import DailyQuotaExceeded, Paced, Pool, QuotaExceeded, backoff, halving


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds


def test_pool_turns_and_rests():
    clock = Clock()
    pool = Pool(["a", "b"], clock=clock, sleep=clock.sleep)
    assert [pool.call(lambda m: m) for _ in range(3)] == ["a", "b", "a"]
    calls = []

    def limited(model):
        calls.append(model)
        if len(calls) < 3:
            raise RuntimeError("429 too many")
        return model

    assert pool.call(limited) == "b" and 59 < clock.now < 61.5
    clock.now = 1000.0

    def daily(model):
        raise RuntimeError("quota for the day")

    with pytest.raises(DailyQuotaExceeded):
        pool.call(daily)
    with pytest.raises(QuotaExceeded):
        Pool([]).call(lambda m: m)


def test_retry_helpers():
    clock = Clock()
    tries = []

    def failing():
        tries.append(1)
        if len(tries) < 4:
            raise ValueError("x")
        return "ok"

    assert backoff(failing, sleep=clock.sleep) == "ok" and clock.now == 1 + 2 + 4
    with pytest.raises(ValueError):
        backoff(lambda: int("x"), tries=2, sleep=clock.sleep)

    def at_most_two(items):
        if len(items) > 2:
            raise ValueError("Too many tokens")
        return [i * 2 for i in items]

    assert halving(at_most_two, list(range(7)), lambda e: "many" in str(e)) == [0, 2, 4, 6, 8, 10, 12]
    clock.now = 0.0
    paced = Paced(4.1, clock, clock.sleep)
    assert [paced(clock) for _ in range(3)] == [0.0, 4.1, 8.2]
    with pytest.raises(ValueError):
        providers.provider("nobody")


def test_cleaning(spark):
    schema = "id string, title string, text string, url string, language string, extracted_at timestamp"
    long = "a b. " * 1000
    df = spark.createDataFrame([("1", "t", "x" * 99, "u", "pt", None), ("2", "t", "x" * 100, "u", "pt", None), ("3", "t", None, "u", "pt", None), ("4", "t", " " * 200, "u", "pt", None), ("5", "t", long, "u", "pt", None)], schema)
    yes, no = clean.admitted(df)
    assert sorted(r.id for r in no.collect()) == ["1", "3"]
    done, empty = clean.recomposed(clean.cleaned(yes))
    assert [r.id for r in empty.collect()] == ["4"]
    got = {len(r.text): r for r in done.collect()}
    assert set(got) == {100, len(long[:4000].strip()) + 1000} and '"raw_id":"2"' in got[100].metadata


def test_questions_from_long_and_empty_texts(spark):
    df = spark.createDataFrame([("a", "Montanhas antigas guardam segredos profundos desde 1900. Mais nada."), ("b", ""), ("c", "curto"), ("d", "Palavras compridas repetidas. " * 40)], "id string, text string")
    abstracts = {r.id: r for r in qa.abstracts(df, most=500, size=300, overlap=50).collect()}
    assert set(abstracts) == {"a", "c", "d"} and abstracts["d"].keywords == ["compridas", "repetidas"]
    made = qa.generated(qa.abstracts(df, most=500, size=300, overlap=50))
    assert {r.id: r.status for r in made.collect()}["c"] == qa.ASIDE
    flat = qa.flattened(made, "m").collect()
    assert {r.id for r in flat} == {"a", "d"} and all(r.answer and r.reasoning and r.model == "m" for r in flat)


def test_retry_once(spark):
    df = spark.createDataFrame([(1, "timeout"), (2, None), (3, "fatal")], "id int, first string")
    calls = []

    def attempt(rows):
        from pyspark.sql import functions as F

        calls.append(1)
        return rows.withColumn("error", F.col("first") if len(calls) == 1 else F.lit(None).cast("string"))

    from quern.functions.errors import retryable

    assert {r.id: r.error for r in qa.retried(df, attempt, retryable).collect()} == {1: None, 2: None, 3: "fatal"} and len(calls) == 2


def test_chunk_rows_and_listing(spark):
    rows = embedding.chunk_rows(spark.createDataFrame([("a", "x y z"), ("b", "  "), ("c", None)], "id string, text string"), "t", size=2).collect()
    assert [(r.record_id, r.chunk_index, r.chunk_text) for r in sorted(rows, key=lambda r: r.chunk_index)] == [("a", 0, "x y"), ("a", 1, " z")]
    empty = spark.createDataFrame([], "provider string, model_id string")
    assert [r.entry for r in models.listed(empty, ["b"], ["a", "b", "a"], "more").collect()] == ["b", "a", "more"]
    some = spark.createDataFrame([("p", "m"), ("p", "m")], "provider string, model_id string")
    assert [r.entry for r in models.listed(some, [], ["a"]).collect()] == ["p: m"]
    assert models.discovered(spark, {"p": ["x", "y"]}).count() == 2

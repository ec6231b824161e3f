from quern.llm import quality


def test_statistics_of_every_record(spark):
    rows = [("a", None), ("b", ""), ("c", "The mill closed in 1931. Nobody in the valley had expected it."), ("a", None), (None, "x")]
    got = {r.id: r for r in quality.text_statistics(spark.createDataFrame(rows, "id string, text string")).collect()}
    assert set(got) == {"a", "b", "c"}
    assert all(v == 0 for i in "ab" for v in got[i][1:])
    assert got["c"].char_count == 62 and got["c"].p_prose > 0


def test_only_empty_texts(spark):
    df = spark.createDataFrame([("a", None), ("b", "")], "id string, text string")
    assert quality.text_statistics(df).count() == 2


def test_wordless_runs_and_none():
    """Runs of texts without a word, and no texts at all."""
    from quern.llm.lines import Lines

    for texts in (["Hello"], ["   "], ["..."], ["a b"], [""], ["1"], ["\n\n"]):
        assert quality.statistics(Lines(texts)).shape == (1, len(quality.STATS)) and len(quality.weak_labels(Lines(texts))) == 1
    assert quality.statistics(Lines([])).shape == (0, len(quality.STATS))


def test_common_words_of_the_table(spark):
    from quern.llm.lines import hash_words

    rows = [(str(i), f"casa mundo {'raro' if i < 2 else 'outro'} w{i}") for i in range(40)] + [("n", None), ("e", "")]
    got = quality.corpus_words(spark.createDataFrame(rows, "id string, text string").repartition(5), 0.5)
    assert set(got) == set(hash_words(["casa", "mundo", "outro"]))
    assert len(quality.corpus_words(spark.createDataFrame([], "id string, text string"))) == 0


def test_trees_agree_with_clear_labels_they_have_not_seen(spark):
    """The trees see no outcome of the line rules, yet agree with their clear labels on records held out."""
    from quern.llm.chars import slices
    from quern.llm.lines import Lines

    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/raw_corpus.parquet").where("text <> ''").dropDuplicates(["id"]).orderBy("id").select("text").collect()]
    model = quality.fit(texts[::2])
    hits = total = 0
    for _, run in slices(texts[1::2], quality.RUN_CHARS):
        lines = Lines(run, model.member())
        y, k = quality.weak_labels(lines), model.kinds(quality.statistics(lines))
        hits, total = hits + ((k == y) & (y >= 0)).sum(), total + (y >= 0).sum()
    assert hits >= 0.99 * total


def test_counts(spark):
    schema = "id string, text string, char_count bigint, word_count bigint, kind string"
    rows = [("a", "one two three four", 18, 4, ""), ("b", "one two three four", 19, 4, ""), ("c", "one two three four", None, 5, ""), ("d", None, 7, 7, ""), ("a", "one two three four", 18, 4, "")]
    got = sorted(map(tuple, quality.text_kinds(spark.createDataFrame(rows, schema)).where("kind = 'bad_count'").collect()))
    assert got == [("b", "bad_count"), ("c", "bad_count")]

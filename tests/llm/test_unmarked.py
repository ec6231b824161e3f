from quern.llm import unmarked


def test_stripping():
    assert unmarked.stripped("旧灯塔。他笑了！！“真的？”走了") == ("旧灯塔他笑了“真的”走了", [3, 6, 10])
    assert unmarked.stripped("。x") == ("x", []) and unmarked.stripped("") == ("", [])


def test_held_out_documents(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) between 1 and 20000").select("text").distinct().orderBy("text").collect()]
    texts = [t for t in texts if unmarked.unspaced_share(t) >= 0.5]
    field = unmarked.fit(texts[::2])
    right = found = true = 0
    plain = [unmarked.stripped(t) for t in texts[1::2]]
    for (text, ends), got in zip(plain, unmarked.unit_ends([p for p, _ in plain], field)):
        lines, at = set(), 0
        for line in text.split("\n"):
            lines.add(at + len(line.rstrip()))
            at += len(line) + 1
        right, found, true = right + len((set(ends) & set(got)) - lines), found + len(set(got) - lines), true + len(set(ends) - lines)
    assert right >= 0.95 * found and right >= 0.9 * true


def test_odd_documents(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "plain text", 0), (4, "旧灯塔", 0), (4, "旧灯塔", 0), (None, "旧", 0), (5, "旧灯塔\n\n河边 ", 0)], "doc_id long, text string, sent_end int")
    got = sorted(map(tuple, unmarked.unmarked_units(df, unmarked.ConditionalField(2, unmarked.BUCKETS)).collect()))
    assert got == [(4, 3), (5, 3), (5, 7)]
    assert unmarked.unmarked_units(df.limit(0)).collect() == []

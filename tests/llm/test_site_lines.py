from quern.llm import site_lines
from quern.llm.site_lines import LineCounts

SCHEMA = "id string, text string, spider_name string, line_no int"
NOTICE = "Share this page with your friends, edition {}"


def rows(a, b, site="s"):
    return [(f"{site}{i}", f"own line of record number {'x' * i}\n  {NOTICE.format(i).upper()}\n\nshort\n{NOTICE.format('٣')}", site, 0) for i in range(a, b)]


def got(df):
    return sorted(map(tuple, df.select("id", "line_no").collect()))


def test_a_line_is_marked_from_the_twelfth_record_on(spark):
    df = lambda r: spark.createDataFrame(r, SCHEMA)
    assert got(site_lines.repeated_lines(df(rows(0, 11) + rows(0, 11)))) == []
    want = sorted((f"s{i}", n) for i in range(12) for n in (2, 5))
    assert got(site_lines.repeated_lines(df(rows(0, 12) + rows(0, 5) + rows(0, 11, "t")))) == want
    odd = [("n", None, "s", 0), ("e", "", "s", 0), (None, NOTICE, "s", 0)]
    assert got(site_lines.repeated_lines(df(rows(0, 12) + odd))) == want and got(site_lines.repeated_lines(df([]))) == []
    assert got(site_lines.repeated_lines(df([(i, t, None, 0) for i, t, *_ in rows(0, 12)]))) == want


def test_deltas_give_what_the_whole_gives_and_a_store_can_be_opened_again(spark, tmp_path):
    df = lambda r: spark.createDataFrame(r, SCHEMA)
    path = str(tmp_path / "store")
    assert got(LineCounts(spark, path).merge(df(rows(0, 8)))) == []
    again = LineCounts(spark, path)
    assert again.version == 1
    assert got(again.merge(df(rows(6, 12)))) == sorted((f"s{i}", n) for i in range(12) for n in (2, 5))
    third = LineCounts(spark, path)
    assert got(third.merge(df(rows(12, 13) + rows(0, 3)))) == [("s12", 2), ("s12", 5)]
    everything = df(rows(0, 13))
    assert got(third.marks()) == got(site_lines.repeated_lines(everything)) == got(site_lines.merged_lines([df(rows(0, 5)), df(rows(4, 9)), df(rows(9, 13))]))
    rebuilt = {r.id: r.text for r in third.rebuilt(everything).collect()}
    assert list(rebuilt) == ["s12"] and "Share" not in rebuilt["s12"] and rebuilt["s12"].startswith("own line")


def test_clean_texts(spark):
    df = spark.createDataFrame(rows(0, 12) + [("n", None, "s", 0), ("m", "kept", "s", 0), ("m", "kept", "s", 0)], SCHEMA)
    out = {r.id: r.text for r in site_lines.without_lines(df, site_lines.repeated_lines(df)).collect()}
    assert len(out) == 14 and out["n"] is None and out["m"] == "kept" and out["s3"] == "own line of record number xxx\n\nshort"

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import errors, jsons, markup, text, vectors
from quern.operators import chunks


def one(spark, value, *columns, kind="string"):
    return tuple(spark.createDataFrame([(value,)], f"v {kind}").select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


@pytest.mark.parametrize("value", ["", " a  b c d\ne\x1cf ", "x", "  ", "é \x85 ü", None])
def test_counts_and_strip_as_python(spark, value):
    got = one(spark, value, text.char_count("v"), text.word_count("v"), text.strip("v"))
    assert got == ((None,) * 3 if value is None else (len(value), len(value.split()), value.strip()))


def test_nul_prefix_and_recompose(spark):
    assert one(spark, "a\x00b\x00", text.without_nul("v")) == ("ab",)
    assert one(spark, "x" * 4001, F.length(text.recompose(F.lit("y"), "v")), F.length(text.head("v", 4000))) == (2, 4000)
    assert one(spark, "x" * 4000, text.recompose(F.lit("y"), "v")) == ("y",)
    assert one(spark, "   ", text.embedder_input("v"), text.is_blank("v")) == ("empty", True)


def test_markers_only_at_the_start_and_to_the_end(spark):
    strip = text.strip_markers("v", r"\*\*\* START.*?\*\*\*", r"\*\*\* END")
    assert one(spark, "*** start of\nx ***\n body \n*** End ***\nmore", strip) == ("body",)
    assert one(spark, "head\n*** START x ***\nbody", strip) == ("head\n*** START x ***\nbody",)


def test_urls_sources_and_names(spark):
    a = one(spark, "", text.url_or_generated("v", F.lit("k")), text.source_of("v", F.lit("t")), text.first_contained(F.lit("b_a"), ["a", "b"]))
    assert a[0].startswith("generated_url_") and a[1:] == ("t", "a")
    assert one(spark, None, text.source_of("v", "v"), text.first_contained("v", ["a"])) == ("unknown", "unknown")
    assert one(spark, "d/x.parquet.parquet", text.paired_name("v")) == ("x.jsonl.jsonl",)


def test_vectors(spark):
    kind = "array<double>"
    cos = lambda a, b: one(spark, a, vectors.cosine("v", F.lit(b).cast(kind)), kind=kind)[0]
    assert cos([1.0, 0.0], [2.0, 0.0]) == 1 and cos([0.0, 0.0], [1.0, 0.0]) == 0
    assert cos([1.0], [1.0, 0.0]) is None and cos(None, [1.0]) is None and cos([], []) is None
    assert one(spark, " [1, -2.5,3e2] ", vectors.parse("v")) == ([1.0, -2.5, 300.0],)
    assert one(spark, "[]", vectors.parse("v")) == ([],) and one(spark, "[1,x]", vectors.parse("v")) == (None,)
    assert one(spark, 0.12345, vectors.labelled("nli_score", F.col("v")), kind="double")[0] in ("nli_score:0.1235", "nli_score:0.1234")


@pytest.mark.parametrize(
    ("answer", "want"), [('{"a": "1"}', "1"), ('x\n```json\n{"a": "2"}\n```', "2"), ('```\n{"a": "3"}```', "3"), ("nope", None), ("null", None), (None, None), ("```json\n{bad\n```", None)]
)
def test_fenced_json(spark, answer, want):
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert one(spark, answer, jsons.structured("v", schema)["a"]) == (want,)


def test_metadata_text_and_nulls(spark):
    assert one(spark, None, jsons.metadata(a="v", b=F.lit(1))) == ('{"a":null,"b":1}',)
    assert one(spark, "x", jsons.labelled_text(Title=F.col("v"), Topic=F.lit(""), Domain=F.lit(None))) == ("Title: x",)
    assert one(spark, "", jsons.labelled_text(Title=F.col("v"))) == (None,)
    assert one(spark, "not json", jsons.field("v", "a")) == (None,)


@pytest.mark.parametrize(
    ("message", "want"),
    [
        ("Error 429", (True, False, False, False, "API_ERROR")),
        ("quota for the DAY", (True, True, False, False, "API_ERROR")),
        ("ValidationError", (False, False, True, False, "SCHEMA_MISMATCH")),
        ("validationerror", (False, False, False, False, "API_ERROR")),
        ("JSON 400", (False, False, True, False, "SCHEMA_MISMATCH")),
        ("Timeout", (False, False, True, False, "API_ERROR")),
        ("400: token", (False, False, False, True, "CONTEXT_EXCEEDED")),
        (None, (False, False, False, False, "API_ERROR")),
    ],
)
def test_error_classes(spark, message, want):
    assert one(spark, message, errors.rate_limited("v"), errors.daily_limited("v"), errors.retryable("v"), errors.too_many_tokens("v"), errors.error_class("v")) == want


def test_html_with_scripts_and_unclosed_tags(spark):
    html = "<script>var x='</p><p>no'</script><h1> T </h1><h1>U</h1><p>one <b>two<p>three &amp; four</div>out<a href='/a'>x</a><a href='https://own.example/b'>y</a><a href='/a'>z</a>"
    got = spark.createDataFrame([(html,), (None,), ("<p> </p>",)], "h string").select(markup.page("h").alias("p")).select("p.*", markup.links("p", F.lit("https://s.example/q"), "", "own.example").alias("kept")).collect()
    assert tuple(got[0])[:2] == ("T", "one two three & four") and got[0]["kept"] == ["https://s.example/a"]
    assert tuple(got[1])[:3] == (None, None, None) and tuple(got[2])[:2] == ("untitled", "")


def test_language(spark):
    assert one(spark, "The report of the town was not published by the committee", text.language("v")) == ("en",)
    assert one(spark, "O relatório não foi publicado pelo jornal", text.language("v")) == ("pt",)
    assert one(spark, "short", text.language("v")) == ("unknown",) and one(spark, None, text.language("v")) == ("unknown",)


@pytest.mark.parametrize("size", [0, 1, 16, 17, 26, 27, 28, 100])
def test_overlapping_pieces(spark, size):
    value = "".join(chr(97 + i % 26) for i in range(size))
    got = one(spark, value, chunks.overlapping("v", 16, 12, 2))[0]
    want, i = [], 0
    while size > 16:
        want.append(value[i : i + 12])
        if i + 12 >= size:
            break
        i += 10
    assert got == (want or [value])


def test_chunks_by_words_and_tokens(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, " "), (3, None), (4, "a b")], "id long, text string")
    assert sorted(map(tuple, chunks.by_words(df, 2).collect())) == [(1, 0, "a b"), (1, 1, "c d"), (1, 2, "e"), (4, 0, "a b")]
    rows = chunks.by_tokens(df, lambda t: list(t), 4).orderBy("id", "chunk_index").collect()
    assert "".join(r.chunk_text for r in rows if r.id == 1) == "a b c d e" and len([r for r in rows if r.id == 1]) == 3
    numbered = chunks.batches(df.repartition(1), 2, "id").collect()
    assert [len({r.id for r in numbered if r.batch == b}) for b in sorted({r.batch for r in numbered})] == [2, 2]

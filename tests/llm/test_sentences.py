import pytest

from quern.llm import sentences


def units(texts, model=None):
    model = model or sentences.fit(texts * 3)
    docs, ends = sentences.unit_ends(texts, model)
    out, at = [[] for _ in texts], {}
    for d, e in zip(docs.tolist(), ends.tolist()):
        out[d].append(texts[d][at.get(d, 0) : e].strip())
        at[d] = e
    return out


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("The mill closed. Nobody knew.", ["The mill closed.", "Nobody knew."]),
        ("Dr. Hale came at 5.30 p.m. and left.", ["Dr. Hale came at 5.30 p.m. and left."]),
        ("See fig. 3 and a.txt today! Was it far?", ["See fig. 3 and a.txt today!", "Was it far?"]),
        ("“Is it far?” asked Ana. It was.", ["“Is it far?” asked Ana.", "It was."]),
        ("旧灯塔在河边。他笑了！", ["旧灯塔在河边。", "他笑了！"]),
        ("A heading\n\nA line\nbroken here. End", ["A heading", "A line\nbroken here.", "End"]),
        ("", []),
        (" \n ", []),
    ],
)
def test_units(text, want):
    assert units([text]) == [want]


def test_abbreviations_are_learned_from_the_whole_table(spark):
    rows = [(i, f"They met on Jan. {i % 28 + 1} near gate No. {i}. It was cold. He went to town. Approx. {i} of them left in the cold. To town they came.") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    learned = set(sentences.learned_abbreviations(df).tolist())
    has = lambda w: int(sentences._hash([w])[0]) in learned
    assert has("jan") and has("approx") and not has("cold") and not has("town")
    got = {(r.doc_id, r.sent_end) for r in sentences.sentence_units(df).collect()}
    text = rows[3][1]
    assert sorted(e for d, e in got if d == 3) == [text.index(" It was"), text.index(" He went"), text.index(" Approx"), text.index(" To town"), len(text)]


def test_the_chain_is_learned_from_a_sample_not_from_a_table(spark):
    """Categories the sample lacks are judged from their parts: no disagreement with the labelling function on other documents."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text <> ''").orderBy("doc_id").select("text").collect()]
    model = sentences.fit(texts[::3])
    found = sentences.Candidates(texts[1::3], abbreviations=model.abbreviations)
    tags = model.decode(sentences._columns(found.cat, found.pair), found.doc)
    assert (tags == sentences.weak_labels(found.cat)).mean() > 0.999


def test_repeated_and_odd_documents(spark):
    rows = [(1, "One. Two.", 0), (1, "One. Two.", 0), (2, None, 0), (3, "", 0), (None, "x.", 0), (4, "a" * 200_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sent_end int")
    got = sorted(map(tuple, sentences.sentence_units(df).collect()))
    assert got == [(1, 4), (1, 9), (4, 200_000)]
    assert sentences.sentence_units(df.limit(0)).collect() == []

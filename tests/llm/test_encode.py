import random

from quern.llm import encode

TEXTS = [
    "we'l" + "l go, they've x'red and we're; it'd 's 't'm ''ll '''ve !!'re",
    "a  b\n\n  c \t\n d   e  'l\n 'll   \n",
    "café naïve 旧灯塔 डाल 123 4567'll  \U0001f469‍\U0001f52c's",
]


def test_every_cut_gives_the_whole_encoding():
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("' lverdstm  \n!a1é") for _ in range(40)) for _ in range(150)]
    whole = encode.coder().encode_ordinary
    for t in texts:
        for i in range(len(t) + 1):
            assert encode._flat(encode.concat(encode.leaf(t[:i]), encode.leaf(t[i:]))) == whole(t), (t, i)


def test_every_leaf_size_gives_the_whole_encoding():
    for t in [*TEXTS, "l" * 90 + "'ll" + " " * 40 + "x" * 70]:
        for n in range(1, len(t) + 1):
            assert encode.encode_long(t, n) == encode.coder().encode_ordinary(t), (t, n)


def test_long_texts_of_the_table_take_the_tree(spark):
    n = encode.LEAF_CHARS
    texts = ["x " * (n // 2 - 1) + "'l" + "l go on" + " and on" * 10, "we'l" * 3, "", None]
    assert encode.LONG_CHARS < len(texts[0])
    rows = encode.encode_corpus(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: encode.coder().encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_levels_of_the_tree(spark):
    """Hundreds of leaves, joined level by level, one and the same text twice, and texts within a leaf."""
    rng = random.Random(9)
    texts = ["".join(rng.choice(["we'll", " ", "'s", "rio", "\n", "  ", "1a", "é", "'ve", "旧"]) for _ in range(n)) for n in (2, 60, 700, 1500)]
    rows = [*enumerate(texts), (9, texts[2]), (9, texts[2]), (10, None)]
    got = encode.encode_corpus(spark.createDataFrame(rows, "doc_id long, text string"), long_chars=30, leaf_chars=20).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == encode.coder().encode_ordinary(dict(rows)[r.doc_id] or "")

import random

from quern.llm import split

CHUNKS = "id string, record_id string, table_name string, chunk_index int, chunk_text string"


def sample(rng, n):
    words = ["a", "casa", "do", "rio", "velho", "xyzzy" * 3, "旧灯塔", "fim"]
    out = ""
    while len(out) < n:
        out += " ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) + rng.choice([". ", ".\n", ".\n\n", "! ", "。", ", "])
    return out


def test_pieces_are_legal_and_cover_the_text():
    rng = random.Random(1)
    for n in (1201, 1500, 5_000, 40_000):
        text = sample(rng, n)
        pieces = split.split_text(text)
        assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
        for (a, b), (c, d) in zip(pieces, pieces[1:]):
            assert b - c >= 80 and c > a and d > b
        assert all(b - a <= 1200 for a, b in pieces)
        assert all(not (text[b - 1].isalnum() and text[b].isalnum()) or text[b - 1] >= "一" for _, b in pieces[:-1])
    assert split.split_text("x" * 1200) == [(0, 1200)] and all(b - a <= 1200 for a, b in split.split_text("x" * 5000))


def test_program_is_as_good_as_trying_everything():
    """Against all paths over the same boundary positions of a short text."""
    rng = random.Random(2)
    for _ in range(20):
        text = sample(rng, 130)[:130].strip()
        limit, overlap = 60, 5
        pieces = split.split_text(text, limit, overlap)
        marks = split.boundaries(text)
        cost = sum(float(split.piece_cost(b - a, marks.get(b, split.bare_penalty(text[b - 1], text[b])) if b < len(text) else 0.0, limit)) for a, b in pieces)
        ends = sorted({b for _, b in pieces} | {p for p, c in marks.items() if c < 0.6})
        nexts = {b: c for (_, b), (c, _) in zip(pieces, pieces[1:])}

        def best(at, start):
            if at == len(text):
                return 0.0
            out = float("inf")
            for e in ends:
                if e > at and e - start <= limit and (e in nexts or e == len(text)):
                    own = float(split.piece_cost(e - start, marks.get(e, 3.0) if e < len(text) else 0.0, limit))
                    out = min(out, own + best(e, nexts.get(e, e)))
            return out

        assert cost <= best(0, 0) + 1e-9


def test_own_pieces_have_no_fault(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(str(i), sample(rng, 4000).replace("旧灯塔", "faro")) for i in range(8)] + [("s", "short"), ("n", None)], "id string, text string")
    cut = split.split_texts(docs).selectExpr("concat(record_id, '-', chunk_index) as id", "record_id", "'raw_corpus' as table_name", "chunk_index", "chunk_text")
    assert cut.count() > 20 and split.piece_faults(cut, docs).collect() == []


def test_faults(spark):
    text = "".join(f"w{i:06d} " for i in range(400))
    a, b = text[:1000], text[920:1904]
    rows = [
        ("1", "r", "raw_corpus", 0, a), ("2", "r", "raw_corpus", 1, b), ("3", "r", "raw_corpus", 3, text[2200:2504]), ("4", "r", "odd", 2, text[1840:2304]), ("5", "r", "qa_dataset", 5, text[:1201]),
        ("6", "r", None, 0, text[:1204]), ("7", "r", "raw_corpus", 1, "other words " * 20), ("1", "r", "raw_corpus", 0, a), ("8", "gone", "raw_corpus", 0, "x"), ("9", "r", "raw_corpus", None, None), ("m", "r", "raw_corpus", 0, text[:995]),
    ]
    df = spark.createDataFrame(rows, CHUNKS)
    records = spark.createDataFrame([("r", text), ("r", text), ("z", None)], "id string, text string")
    got = sorted(map(tuple, split.piece_faults(df, records).collect()))
    assert got == [("4", "no_overlap"), ("5", "oversize"), ("6", "mid_word"), ("6", "oversize"), ("7", "no_overlap"), ("m", "mid_word")]
    assert split.piece_faults(df.limit(0), records.limit(0)).collect() == []


def test_texts_delivered_twice_are_cut_once(spark):
    long = sample(random.Random(5), 3000)
    rows = [("a", long), ("a", long), ("b", long), (None, long)]
    got = split.split_texts(spark.createDataFrame(rows, "id string, text string")).collect()
    n = len(split.split_text(long))
    assert sorted((r.record_id or "", r.chunk_index) for r in got) == sorted((i, k) for i in ("", "a", "b") for k in range(n))

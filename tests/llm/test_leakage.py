import random

import numpy as np

from quern.llm import leakage

WORDS = "river stone letter window garden bridge market winter copper silver candle harbor meadow thunder pepper ribbon saddle timber valley wander".split()
ITEM = " ".join(WORDS)
DOCS = "doc_id string, text string, item_id string"


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, DOCS)
    i = spark.createDataFrame(items, "item_id int, text string, doc_id int")
    return {(r.doc_id, r.item_id) for r in leakage.leaked(d, i, **more).collect()}


def test_exact_rule_and_odd_rows(spark):
    part = " ".join(WORDS[3:15])
    docs = [
        ("all", f"x {ITEM} y", ""), ("part", f"x {part.upper()}, y", ""), ("short", f"x {' '.join(WORDS[3:14])} y", ""), ("tags", "x " + part.replace("garden", f"<span style='{'a' * 900}'>garden</span>") + " y", ""),
        ("broken", "x " + part.replace("bridge", "bri-\ndge") + " y", ""), ("inside", "x pre" + part + "fix y", ""), ("null", None, ""), ("empty", "", ""), ("all", f"x {ITEM} y", ""),
    ]
    items = [(7, ITEM, 0), (7, ITEM, 0), (8, None, 0), (9, "too short", 0), (10, "", 0)]
    assert found(spark, docs, items) == {("all", 7), ("part", 7), ("tags", 7), ("broken", 7)}
    assert found(spark, [], items) == set() and found(spark, docs, []) == set()


def test_changed_letters_are_aligned(spark):
    changed = [w if i % 11 else w[:-1] + "q" for i, w in enumerate(WORDS)]
    longer = [w + "x" if i == 9 else w for i, w in enumerate(WORDS)]
    lost = [w[1:] if i == 10 else w for i, w in enumerate(WORDS)]
    docs = [("sub", " ".join(changed), ""), ("ins", " ".join(longer), ""), ("del", " ".join(lost), ""), ("far", " ".join(w[::-1] for w in WORDS), "")]
    d = spark.createDataFrame(docs, DOCS)
    i = spark.createDataFrame([(1, ITEM)], "item_id int, text string")
    got = {r.doc_id: (r.first_word, r.words, r.edits) for r in leakage.passages(d, i).collect()}
    assert got == {"sub": (1, 19, 1), "ins": (0, 20, 1), "del": (0, 20, 1)}
    assert leakage.leaked(d, i).collect() == []


def brute(doc: str, item: str, k: int = 12) -> bool:
    a, b = doc.split(), item.split()
    parts = {tuple(a[i : i + k]) for i in range(len(a) - k + 1)}
    return any(tuple(b[i : i + k]) in parts for i in range(len(b) - k + 1))


def test_against_brute_force():
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(10, 40)))) for i in range(30)]
    texts = []
    for _ in range(200):
        own = rng.choice(items)[1].split()
        at, n = rng.randrange(len(own)), rng.randint(8, 20)
        texts.append(" ".join([rng.choice(WORDS) for _ in range(rng.randint(0, 30))] + own[at : at + n] + [rng.choice(WORDS) for _ in range(10)]))
    got = {(d, i) for d, i, *_ in leakage.ItemIndex(items).find(texts)}
    assert got == {(d, i) for d, t in enumerate(texts) for i, x in items if brute(t, x)} and got


def distance(a: str, b: str) -> int:
    row = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, y in enumerate(b, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
        row = new
    return int(row[-1])


def test_alignment_against_edit_distance():
    rng = random.Random(8)
    index = leakage.ItemIndex([(1, ITEM)], q=8, edits=3)
    whole = ITEM.replace(" ", "")
    for k in range(4):
        for _ in range(20):
            text = list(ITEM)
            for _ in range(k):
                at = rng.randrange(20, len(text) - 20)
                if text[at] != " ":
                    text[at] = rng.choice(["z", "", text[at] + "z"])
            doc = "".join(text)
            true = distance(doc.replace(" ", ""), whole)
            (hit,) = index.find([doc], False)
            assert hit[2:4] == (0, 20) and hit[4] == true

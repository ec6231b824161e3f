import random

import pytest
from pyspark.sql import functions as F

from quern.llm import pairs

SUBJECTS = ["a escola rural", "o velho farol", "o relatório da comissão", "a turma do sexto ano", "o caderno de campo"]
VERBS = ["transformou", "ampliou", "descreve", "sustenta", "reduziu"]
OBJECTS = ["o mapa das trilhas", "a memória dos moradores", "o preço do trigo", "o ciclo das chuvas"]


def made(n=400):
    """Sound rows, to learn from."""
    rng = random.Random(2)
    say = lambda: f"{rng.choice(SUBJECTS)} {rng.choice(VERBS)} {rng.choice(OBJECTS)}"
    rows = []
    for i in range(n):
        fact = say()
        rows.append((f"s{i}", f"Por que {fact}?", f"{fact[0].upper()}{fact[1:]}, já que {say()}. Além disso, {say()} sem custos adicionais, enquanto {say()}."))
    return rows + [(f"n{i}", f"Quantos são os {w}?", f"Cerca de {3 * i}.") for i, w in enumerate(["livros", "mapas", "barcos", "moinhos", "alunos", "dias", "anos", "grupos"] * 3)]


CASES = [
    ("c1", "Por que o velho farol reduziu o preço do trigo?", None, "empty"),
    ("c2", "Por que o velho farol reduziu o preço do trigo?", " n/a ", "empty"),
    ("c3", "Por que o velho farol reduziu o preço do trigo?", "—", "empty"),
    ("c4", "Por que o velho farol reduziu o preço do trigo?", "O velho farol reduziu o preço do trigo, já que a escola rural ampliou o mapa das trilhas. Além disso, a turma do sexto ano descreve a mem", "truncated"),
    ("c5", "Por que o velho farol reduziu o preço do trigo?", "Por que o velho farol reduziu o preço do trigo?", "copied"),
    ("c6", "Por que o velho farol reduziu o preço do trigo?", "Porque o velho farol reduziu o preço do trigo.", "copied"),
    ("c7", "Por que o velho farol reduziu o preço do trigo?", "Desculpe, mas não posso responder a essa pergunta.", "refusal"),
    ("c8", "Por que o velho farol reduziu o preço do trigo?", "The rural school widened the map of the trails, since the old lighthouse is on the bank of the river and the price of wheat was low.", "other_language"),
    ("c9", "Por que o velho farol reduziu o preço do trigo?", "O velho farol reduziu o preço do trigo, uma vez que a escola rural ampliou o mapa das trilhas.", None),
    ("c10", "Quantos são?", "Cerca de 40.", None),
]


@pytest.fixture(scope="module")
def field():
    return pairs.fit([(q, a) for _, q, a in made()])


def test_every_defect(spark, field):
    rows = [(i, q, a) for i, q, a, _ in CASES] + made(60)
    df = spark.createDataFrame(rows + rows[:8], "id string, question string, answer string").withColumn("defect", F.lit(1))
    got = {r.id: r.defect for r in pairs.pair_defects(df, field).collect()}
    assert {i: got.get(i) for i, *_ in CASES} == {i: d for i, _, _, d in CASES}
    assert sum(i[0] in "sn" for i in got) <= 2


def test_question_may_ask_for_a_language(field):
    ask = "Como se diz em inglês a frase “o velho farol reduziu o preço do trigo”?"
    assert pairs.Question(ask).allowed == {"pt", "en"}
    assert pairs.judge(field, [ask], ["The old lighthouse reduced the price of wheat in the region, as it was on the bank of the river."]) == [None]


def test_odd_rows(spark, field):
    rows = [("a", None, "Sim, desde 1900."), ("b", None, None), (None, "x", "y"), ("d", "", "x" * 200_000 + "."), ("e", "?", "\x00\n\n")]
    got = {r.id: r.defect for r in pairs.pair_defects(spark.createDataFrame(rows, "id string, question string, answer string"), field).collect()}
    assert got.get("b") == "empty" and got.get("e") == "empty" and None not in got
    empty = spark.createDataFrame([], "id string, question string, answer string")
    assert pairs.pair_defects(empty).collect() == []


def test_the_field_finds_what_its_seed_rules_do_not(field):
    """The tags are learned: refusals in words that no seed pattern has are found too."""
    said = ["Infelizmente, não tenho permissão para tratar disso. Posso ajudar em outra coisa?", "Não conheço o tema; consulte um especialista, pois faltam dados."]
    assert not any(pairs.DECLINES.search(s) for s in said)
    assert pairs.judge(field, ["Por que o velho farol reduziu o preço do trigo?"] * 2, said) == ["refusal", "refusal"]


def test_field_gradient_raises_likelihood():
    import numpy as np

    from quern.llm.crf import ConditionalField

    rng = np.random.default_rng(0)
    xs = [[np.array([int(v)]) for v in rng.integers(0, 4, 6)] for _ in range(200)]
    ys = [[int(f[0]) % 2 if i == 0 else int(f[0] > 1) for i, f in enumerate(x)] for x in xs]
    got = ConditionalField(2, 4).fit(xs, ys, rounds=30, batch=32).decode(xs)
    assert np.mean([list(g[1:]) == y[1:] for g, y in zip(got, ys)]) > 0.95

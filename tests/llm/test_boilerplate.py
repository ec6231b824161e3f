import random

from quern.llm import boilerplate

SCHEMA = "id string, text string, spider_name string, url string, site int"
MENU = ["Busca avançada", "Fale conosco", "Sobre nós"]
PROSE = "O velho farol de {0} ainda está na margem do rio {1}, e no verão chegam muitas pessoas que não conhecem a história da casa nem dos que ali moraram."
STARTS = ["O velho farol", "A escola", "Um barco", "O relatório", "A turma", "Cada vila", "Certa casa", "Outro rio", "Toda ponte", "Nenhum moinho", "Este mapa", "Aquela praça"]


def pages(n=40):
    rng = random.Random(3)
    name = lambda: "".join(rng.choice(["ba", "co", "du", "fe", "gi"]) for _ in range(4)).title()
    rows = []
    for i in range(n):
        body = [PROSE.format(name(), name()).replace("O velho farol", STARTS[(i + 5 * j) % 12] + " " + STARTS[(7 * i + j) % 12].lower()) for j in range(3)]
        top = rng.sample(MENU, 2) + [f"Início > {name()}"]
        end = [f"© {2000 + i % 9} Caderno Malva. Todos os direitos reservados.", f"{i} comentários"] + [f"- {name()} {name()}" for _ in range(i % 3)]
        rows.append((f"a{i:03d}", "\n".join([*top, "", "Resumo" if i in (5, 25) else name(), *body, *end]), "malva_pt", None, 1))
    return rows


def test_menus_and_notices_go_and_content_stays(spark):
    rows = pages()
    df = spark.createDataFrame(rows + rows[:3], SCHEMA)
    got = {(r.id, r.line_no) for r in boilerplate.furniture_lines(df).collect()}
    assert len(got) == boilerplate.furniture_lines(df).count()
    for i, text, *_ in rows:
        for n, line in enumerate(text.split("\n"), 1):
            furniture = line in MENU or line.startswith(("Início >", "©")) or line.endswith("comentários")
            assert ((i, n) in got) == furniture, line


def test_main_text(spark):
    rows = pages()
    got = {r.id: r.text for r in boilerplate.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all("©" not in t and "Busca" not in t and t.count("ainda está") == 3 for t in got.values()) and len(got) == 40


def test_salted_way_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame(pages() + [(f"b{i}", f"Menu\n{PROSE.format(i, i)}", "other_en", None, 1) for i in range(9)], SCHEMA)
    want = sorted(map(tuple, boilerplate.furniture_lines(df).collect()))
    monkeypatch.setattr(boilerplate, "BOOK_BYTES", -1)
    assert sorted(map(tuple, boilerplate.furniture_lines(df).collect())) == want and want


def test_nothing_to_find(spark):
    rows = [("a", None, "s", None, 1), ("b", "", "s", None, 1), ("c", " \n\t\n", None, "https://x.example/1", 1), ("d", "Menu\n" + "x" * 100_000, None, None, 1), (None, "Menu", "s", None, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.id for r in boilerplate.furniture_lines(df).collect()} <= {"d"}
    assert {r.id for r in boilerplate.main_texts(df).collect()} == {"c", "d"}
    assert boilerplate.furniture_lines(df.limit(0)).collect() == []


def test_sites_the_book_does_not_know(spark):
    book = boilerplate.fitted(spark.createDataFrame(pages(), SCHEMA))
    new = spark.createDataFrame([("z", "Busca avançada\nx", "neu_de", None, 1), ("y", "Busca avançada\nx", "malva_pt", None, 1)], SCHEMA)
    assert sorted(map(tuple, boilerplate.furniture_lines(new, book).collect())) == [("y", 1)]

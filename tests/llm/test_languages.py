import __spark_entry__ as driver
from quern.llm import languages

LABELS = {"pt": {"pt"}, "pt_PT": {"pt"}, "es-419": {"es"}, "de-AT": {"de"}, "en-DE": {"en"}, "Português": {"pt"}, "日本語": {"ja"}, "por": {"pt"}, "en, fr": {"en", "fr"}, "": set(), None: set(), "und": set(), "xx": set()}
PT = "O velho farol ainda está na margem do rio, e no verão chegam muitas pessoas que não conhecem a história. Uma vez que há poucos dados, o relatório da comissão ficou por escrever."
ES = "El viejo faro sigue en la orilla del río, y en verano llegan muchas personas que no conocen la historia. Puesto que hay pocos datos, el informe de la comisión quedó por escribir."
RU = "Старый маяк всё ещё стоит на берегу реки, и летом сюда приезжает много людей, которые не знают его истории."


def test_labels_name_languages():
    assert {k: languages.named(k) for k in LABELS} == LABELS


def test_unnamed_languages_of_whole_lines(spark):
    rows = [
        ("a", f"{PT}\n{ES}", "s", "pt-BR"),
        ("b", f"{PT}\n{PT[:90]}.", "s", "pt"),
        ("c", RU, "s", None),
        ("d", f"{ES}\n{RU}", "s", "español"),
        ("e", None, "s", "pt"),
        ("e2", "", "s", None),
        ("d", f"{ES}\n{RU}", "s", "español"),
        ("f", PT, "t", "pt"),
        ("g", ES, "t", "es"),
    ]
    df = spark.createDataFrame(rows, "id string, text string, spider_name string, language string")
    got = sorted(map(tuple, languages.unnamed_languages(df).collect()))
    assert got == [("a", "es"), ("c", "ru"), ("d", "ru")]
    assert languages.unnamed_languages(df.limit(0)).collect() == []


def test_registered():
    assert "p4_found" in driver.queries()

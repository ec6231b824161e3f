"""Language of every long line by zstandard dictionaries.

A line belongs to the language whose dictionary compresses it best; its confidence is the lead over the next
language as a share of the line's bytes, and a line without a clear lead has no language. Only languages of the
line's prevailing script compete, so a script with one language needs no compression. The dictionaries are raw
stretches of the corpus's own prose: a bounded sample of records is split in two, the dictionaries of each half
(lines on whose language the label and a few seed sentences agree) judge the lines of the other, and the lines so
judged fill the final dictionaries. The seeds stand in every dictionary, for languages the sample shows too rarely.

Lines of main content are those of natural prose records (``quality``) that the vote of their site does not call
furniture (``boilerplate``).

Defined cases: null and empty texts have no lines; null, empty and unknown labels name no language; an id delivered
twice counts once; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from quern.llm import boilerplate, quality
from quern.llm.chars import LETTER, classes, codes, slices
from quern.llm.lines import Lines
from quern.llm.sampling import bounded_texts

MIN_LETTERS = 40
MIN_LEAD = 0.03
SEED_LEAD = 0.015
DICT_BYTES = 110_000
LEVEL = 1
LATIN = ["pt", "en", "es", "fr", "de", "it"]
NAMES = {
    "pt": "pt por portuguese português portugues",
    "en": "en eng english",
    "es": "es spa spanish español espanol castellano castilian",
    "fr": "fr fra fre french français francais",
    "de": "de deu ger german deutsch",
    "it": "it ita italian italiano",
    "ru": "ru rus russian русский",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 漢語 普通话",
    "ja": "ja jpn japanese 日本語",
    "ar": "ar ara arabic العربية",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "th": "th tha thai ไทย ภาษาไทย",
}
CODE_OF = {name: code for code, names in NAMES.items() for name in names.split()}
SEEDS = {
    "pt": "O relatório da comissão não foi publicado, mas os moradores já sabiam o que estava escrito. Quando a chuva parou, as crianças saíram para o pátio e ninguém mais falou nisso. Uma vez que há poucos dados, são necessárias outras medidas. ",
    "en": "The report of the committee was not published, but the people of the town already knew what it said. When the rain stopped, the children went out into the yard and nobody spoke of it again. Since there are few data, other measures are needed. ",
    "es": "El informe de la comisión no fue publicado, pero los vecinos ya sabían lo que decía. Cuando dejó de llover, los niños salieron al patio y nadie volvió a hablar de ello. Puesto que hay pocos datos, se necesitan otras medidas. ",
    "fr": "Le rapport de la commission n'a pas été publié, mais les habitants savaient déjà ce qu'il disait. Quand la pluie s'est arrêtée, les enfants sont sortis dans la cour et personne n'en a plus parlé. Puisqu'il y a peu de données, d'autres mesures sont nécessaires. ",
    "de": "Der Bericht der Kommission wurde nicht veröffentlicht, aber die Bewohner wussten schon, was darin stand. Als der Regen aufhörte, gingen die Kinder auf den Hof und niemand sprach mehr davon. Da es wenige Daten gibt, sind weitere Messungen nötig. ",
    "it": "La relazione della commissione non è stata pubblicata, ma gli abitanti sapevano già che cosa diceva. Quando la pioggia è cessata, i bambini sono usciti nel cortile e nessuno ne ha più parlato. Poiché ci sono pochi dati, sono necessarie altre misure. ",
}
SCRIPTS = [("ru", r"[Ѐ-ԯ]"), ("ar", r"[؀-ۿݐ-ݿﭐ-﷿ﹰ-ﻼ]"), ("hi", r"[ऀ-ॣ०-ॿ]"), ("th", r"[ก-๎]"), ("ja", r"[ぁ-ヿㇰ-ㇿｦ-ﾝ]"), ("zh", r"[㐀-鿿豈-﫿]")]
_OTHER = re.compile("[" + "".join(chars[1:-1] for _, chars in SCRIPTS) + "]")
_SCRIPTS = [(code, re.compile(chars)) for code, chars in SCRIPTS]


def named(label: str | None) -> set[str]:
    """The languages a label names: by code, code with region, English or own name; several may be listed."""
    out = set()
    for part in re.split(r"[,;/|+&\s]+", (label or "").strip().casefold()):
        code = CODE_OF.get(part) or CODE_OF.get(re.split(r"[-_]", part)[0])
        if code:
            out.add(code)
    return out


def letters_of(line: str) -> int:
    return int((classes()[codes(line)] == LETTER).sum())


def script(line: str, letters: int | None = None) -> str | None:
    """The language of a script that writes most of the line's letters; None for the Latin script."""
    if line.isascii() or not _OTHER.search(line):
        return None
    letters = letters_of(line) if letters is None else letters
    count = {code: len(chars.findall(line)) for code, chars in _SCRIPTS}
    if sum(count.values()) <= letters / 2:
        return None
    if count["ja"] >= 0.1 * (count["ja"] + count["zh"]) and count["ja"]:  # kana among ideographs
        count["ja"] += count["zh"]
        count["zh"] = 0
    return max(count, key=count.get)


class Dictionaries:
    """Compressors of the Latin-script languages; built where they are used, as they cannot be sent."""

    def __init__(self, data: dict[str, bytes]):
        self.data = data
        self._coders = None

    def __getstate__(self) -> dict:
        return {"data": self.data, "_coders": None}

    def best(self, line: str) -> tuple[str, float]:
        """(language, lead over the next one as a share of the line's bytes)."""
        if self._coders is None:
            self._coders = []
            for code, data in self.data.items():
                own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                own.precompute_compress(level=LEVEL)
                self._coders.append((code, zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False).compress))
        raw = line.encode("utf-8", "replace")
        (best, code), (second, _) = sorted([(len(press(raw)), code) for code, press in self._coders])[:2]
        return code, (second - best) / len(raw)


def dictionaries(lines: list[tuple[str, str]]) -> Dictionaries:
    """From (language, line) pairs; the seed stands at the end, where matches are cheapest."""
    data = {}
    for code in LATIN:
        own = "\n".join(line for lang, line in lines if lang == code).encode("utf-8", "replace")
        data[code] = own[: DICT_BYTES - 1_000] + b"\n" + SEEDS[code].encode()
    return Dictionaries(data)


def judged(own: quality.QualityModel, lines: Lines, run: list[str]) -> list[list[tuple[int, str, int]]]:
    """(line number, line, letters) of the long lines of each text of natural prose."""
    kind = own.kinds(quality.statistics(lines))
    out, at = [], 0
    for k, text in zip(kind, run):
        each = text.split("\n")
        letters = lines.letters[at : at + len(each)]
        at += len(each)
        out.append([(i + 1, each[i], int(letters[i])) for i in (letters >= MIN_LETTERS).nonzero()[0]] if k == 0 else [])
    return out


class LanguageModel:
    def __init__(self, kinds: quality.QualityModel, latin: Dictionaries):
        self.kinds, self.latin = kinds, latin

    def line(self, line: str, letters: int | None = None) -> tuple[str, float]:
        own = script(line, letters)
        return (own, 1.0) if own else self.latin.best(line)


def fitted(df: DataFrame, book: boilerplate.Book) -> LanguageModel:
    """Fitted on a bounded sample of labelled and unlabelled records, without their furniture."""
    rows = bounded_texts(df, "id", "text", "language", boilerplate.site_column(df), rows=quality.TRAIN_ROWS, chars=quality.TRAIN_CHARS, longest=quality.LONG_CHARS)
    sites = book.some({r["site"] for r in rows})
    texts = [boilerplate.main_text(sites[r["site"]], r["text"]) for r in rows]
    kinds = quality.fit([r["text"] for r in rows], quality.corpus_words(df))
    member = kinds.member()
    found = []
    for first, run in slices(texts):
        found += [(first + i, line, letters) for i, each in enumerate(judged(kinds, Lines(run, member), run)) for _, line, letters in each]
    often = Counter(line for _, line, _ in found)
    latin = [(i, line) for i, line, letters in found if often[line] <= 2 and script(line, letters) is None]
    # A wrong label of a frequent language would fill the dictionary of a rare one: label and seeds must agree.
    seeds = dictionaries([])
    agreed = [(i, code, line) for i, line in latin for code in named(rows[i]["language"]) for best, lead in [seeds.best(line)] if best == code and lead >= SEED_LEAD]
    halves = [dictionaries([(code, line) for i, code, line in agreed if i % 2 == half]) for half in (0, 1)]
    sure = []
    for i, line in latin:
        code, lead = halves[1 - i % 2].best(line)
        if lead >= MIN_LEAD:
            sure.append((code, line))
    return LanguageModel(kinds, dictionaries(sure))


def line_languages(df: DataFrame, model: LanguageModel | None = None, book: boilerplate.Book | None = None, unnamed: bool = False) -> DataFrame:
    """(id, line_no, lang, confidence) of each long line of main content of natural prose; only those whose
    language the record's label does not name where ``unnamed`` is set."""
    book = book or boilerplate.fitted(df)
    model = model or fitted(df, book)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(parts) -> Iterator[pa.RecordBatch]:
        own = shared.value
        member = own.kinds.member()
        labels: dict[str | None, set[str]] = {}
        for sites, texts, ids, label in parts:
            found: dict[int, list[tuple[int, str, float]]] = {}
            for i, (site, text) in enumerate(zip(sites, texts)):
                if label[i] not in labels:
                    labels[label[i]] = named(label[i])
                known = labels[label[i]] if unnamed else ()
                for number, line in enumerate(text.split("\n"), 1):
                    if len(line) < MIN_LETTERS:
                        continue
                    code, lead = own.line(line)
                    # Letters are counted and paths made only for the few lines that pass the cheaper tests.
                    if lead >= MIN_LEAD and code not in known and letters_of(line) >= MIN_LETTERS and not (len(line) <= boilerplate.PATH_CHARS and site.wins(line)):
                        found.setdefault(i, []).append((number, code, lead))
            # Only texts with such a line need their kind.
            docs = list(found)
            for first, run in slices([texts[i] for i in docs]):
                kind = own.kinds.kinds(quality.statistics(Lines(run, member)))
                out = [(ids[i], *hit) for i, k in zip(docs[first:], kind) if k == 0 for hit in found[i]]
                cols = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.float64()))], names=["id", "line_no", "lang", "confidence"])

    return book.scan(boilerplate.rows_of(df, "language"), scan, "id string, line_no int, lang string, confidence double", "id", "language")


def unnamed_languages(df: DataFrame, model: LanguageModel | None = None, book: boilerplate.Book | None = None) -> DataFrame:
    """(id, lang): languages of whole lines of main content that the record's label does not name."""
    return line_languages(df, model, book, unnamed=True).select("id", "lang").distinct()

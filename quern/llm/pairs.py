"""Defective question and answer pairs by a conditional random field over the clauses of the answer.

Every clause is tagged as answer, refusal, echo (the question's own words), foreign (another language) or
unfinished; the share of the answer's words under each tag decides the pair's defect (:func:`verdict`). The field
is fitted on a bounded sample of the table's own rows: clear rows with weak tags, and copies of them made defective
in known ways (cut off, echoed, refused, answered in another row's language). No row is tagged by those rules when
the table is judged; they only teach.

What a clause shows: its words and word pairs (names left out, hashed), how many of its words the question has and in
which order, which languages its function words and its script speak for, how it ends and where it stands.

Defined cases: a null or blank answer, marks only and placeholders are ``empty``; a null question counts as one
without words (nothing is copied, no language is foreign); rows delivered twice count once; an empty table gives an
empty result; extra columns are ignored; of several defects the one with most words wins, in the order of ``DEFECTS``.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.crf import ConditionalField, Sequence
from quern.llm.languages import NAMES, SEEDS, script
from quern.llm.sampling import bounded_texts

ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
DEFECTS = ["empty", "truncated", "copied", "refusal", "other_language"]
#: Bounds of the training sample; longer answers are judged like all others but not learned from.
TRAIN_ROWS, TRAIN_CHARS, LONG_CHARS = 3_000, 4_000_000, 20_000
BUCKETS = 1 << 15

#: What stands for no answer.
PLACEHOLDERS = "n/a na none null nil nan undefined todo tbd empty vazio vacío vide leer vuoto".split()
#: Function words by language; words of several languages speak for each of them.
FUNCTION = {
    "pt": "o a os as do da dos das de que não em um uma por para com no na nos nas e foi ao à se mas mais como já são pelo pela sem sob seu sua é ou isso muito quando ainda também até desde sim cerca porque sobre entre segundo conforme ele ela seus suas foram tem há nem mesmo onde qual quem pela pelos",
    "en": "the of and that in to is was for with not on at by an as it be this are from or but which one since because although over while when yes about has have been a",
    "es": "el la los las del de que no en un una por para con y fue al se lo pero más como ya son su sin sobre es o esto muy cuando aunque también hasta desde sí cerca porque según entre ha han él ella sus fueron qué cómo dónde quién cuál",
    "fr": "le la les des du de que ne pas en un une pour avec et au aux dans est sur par ce qui mais plus comme sont son sa sans ou très quand aussi depuis oui environ parce car puisque qu que on il elle ils pourquoi comment où sous entre chez n d l s c j été ont selon près",
    "de": "der die das den dem des und nicht ist von mit im zu ein eine einen auf für als sich auch es an wie aber nach bei aus wird sind oder seit ja etwa weil denn dass",
    "it": "il lo la gli le i del della dei delle di che non in un una per con e è al alla nel nella sul si ma più come sono suo sua senza o molto quando anche fino da dal sì circa perché poiché l d un dell all nell sull tra secondo ha hanno quale chi dove",
}
#: Names a question may call a language by, beside those of its own speakers.
EXONYMS = {
    "pt": "portugués portugais portugiesisch portoghese", "en": "inglês inglés anglais englisch inglese", "es": "espanhol espagnol spanisch spagnolo castelhano",
    "fr": "francês francés französisch francese", "de": "alemão alemán allemand tedesco", "it": "italien italienisch", "ru": "russo ruso russe russisch",
    "zh": "chinês chino chinois chinesisch cinese", "ja": "japonês japonés japonais japanisch giapponese", "ar": "árabe arabe arabisch arabo",
    "hi": "híndi", "th": "tailandês tailandés thaï thailändisch thailandese",
}
#: Seeds: ways in which a speaker declines. They tag training rows, and the samples below are learned from as they are.
DECLINES = re.compile(
    r"\b(?:não (?:posso|consigo|estou autorizad|tenho condições|me é possível)|prefiro não|terei de recusar|devo recusar|foge ao que me|sou (?:só|apenas) um|como (?:assistente|modelo)"
    r"|no (?:puedo|estoy en condiciones|me es posible|estoy autorizad)|prefiero no|debo (?:rechazar|declinar)|tengo que (?:rechazar|declinar)|como (?:asistente|modelo)|va más allá de lo que (?:puedo|me)"
    r"|i (?:cannot|can't|can not|am unable|am not able|am not allowed|would rather not|have to decline|must decline|have no way)|not possible for me|as an? (?:ai |virtual )?(?:assistant|model)|beyond what i"
    r"|je (?:ne peux|ne suis pas|préfère ne|dois (?:refuser|décliner)|regrette)|il ne m'est pas possible|en tant qu'assistant|dépasse ce"
    r"|ich (?:kann|darf|möchte) (?:das |dazu |hierzu |diese frage )?(?:leider )?nicht|als assistent|(?:non posso|non sono (?:in grado|autorizzat)|preferisco non|come assistente))",
    re.IGNORECASE,
)
REFUSALS = [
    ("pt", "Desculpe, mas não posso responder a isso."), ("pt", "Infelizmente, não tenho permissão para tratar desse assunto."), ("pt", "Sou apenas um programa e não conheço o tema; consulte um especialista."),
    ("pt", "Não me sinto em condições de opinar, pois faltam dados. Posso ajudar em outra coisa?"), ("es", "Lo siento, pero no puedo contestar eso."), ("es", "Por desgracia, no tengo permiso para tratar ese asunto."),
    ("es", "Solo soy un programa y desconozco el tema; consulte a un experto."), ("es", "Debo declinar esta petición, pues faltan datos. ¿Puedo ayudar en otra cosa?"), ("en", "Sorry, but I can't answer that."),
    ("en", "Unfortunately, I am not allowed to discuss this."), ("en", "I am only a program and do not know the subject; please ask an expert."), ("en", "I must decline this request, since data are missing. May I help otherwise?"),
    ("fr", "Désolé, je ne peux pas répondre à cela."), ("fr", "Malheureusement, je ne suis pas autorisé à en parler."), ("fr", "Je ne suis qu'un programme et j'ignore ce sujet ; consultez un spécialiste."),
    ("fr", "Je dois décliner cette demande, car il manque des données. Puis-je vous aider autrement ?"), ("de", "Leider kann ich das nicht beantworten."), ("it", "Mi dispiace, ma non posso rispondere a questo."),
]
#: Seeds: what may stand before a refusal as before any answer.
_OPENINGS = ["Em 1950, ", "En 1950, ", "In 1950, ", "Na prática, ", "En la práctica, ", "In practice, ", "En pratique, ", "Além disso, ", "Además, ", "Besides, ", "De plus, "]
#: Seeds: what may stand before a repeated question, and before a circular reason.
ASKED = {"pt": "A pergunta é: ", "es": "La pregunta es: ", "en": "The question is: ", "fr": "La question est : ", "de": "Die Frage lautet: ", "it": "La domanda è: "}
BECAUSE = {"pt": "Porque ", "es": "Porque ", "en": "Because ", "fr": "Parce que ", "de": "Weil ", "it": "Perché "}

_CLAUSE = re.compile(r"[^.!?…。！？।؟;；:,，、\n]*(?:[.!?…。！？।؟;；:,，、]+[\"'”’»)\]]*(?=\s|$)|[。！？।؟，、]|[.!?…;:,]+|\n|$)")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
#: Spellings that speak for a language.
_SPELLED = [("pt", re.compile(r"[ãõ]|ç[aão]|lh[aeo]|nh[aeo]")), ("es", re.compile(r"ñ|ción|ll[aeo]")), ("fr", re.compile(r"[èêœùî]|eux$|oi")), ("de", re.compile(r"[ßäöü]|sch")), ("it", re.compile(r"zion|gli|cch|tt[aeio]$"))]
_OTHER_SCRIPT = re.compile(r"[Ѐ-ԯ؀-ۿऀ-ॿ฀-๿぀-ヿ㐀-鿿]")
_DONE = re.compile(r"[.!?…。！？।؟][\"'”’»)\]]*$")
_LIST = re.compile(r"^\s*(?:[-*•–]|\d{1,3}[.)]|[a-z]\))\s")


@functools.lru_cache(maxsize=1)
def _function_words() -> dict[str, tuple[str, ...]]:
    out: dict[str, list[str]] = {}
    for code, words in FUNCTION.items():
        for w in words.split():
            out.setdefault(w, []).append(code)
    return {w: tuple(c) for w, c in out.items()}


@functools.lru_cache(maxsize=1)
def _names() -> dict[str, str]:
    return {n: code for code, names in [*NAMES.items(), *EXONYMS.items()] for n in names.split() if len(n) > 3 or not n.isascii()}


def languages_of(text: str, words: list[str]) -> Counter:
    """How many words speak for each language; every letter of another script speaks for its language."""
    out: Counter = Counter()
    if _OTHER_SCRIPT.search(text):
        code = script(text, sum(map(str.isalpha, text)))
        if code:
            out[code] = max(2, len(text) // 6)
            return out
    for w in words:
        out.update(_votes(w))
    return out


@functools.lru_cache(maxsize=100_000)
def _votes(word: str) -> tuple[str, ...]:
    """The languages a word speaks for: as a function word (also before an apostrophe), else by its spelling."""
    known = _function_words()
    own = known.get(word) or (known.get(re.split("['’]", word)[0]) if "'" in word or "’" in word else None)
    return own or tuple(code for code, spelled in _SPELLED if spelled.search(word))


def clauses(answer: str) -> list[str]:
    """The answer's clauses with their marks, in order; pieces without a letter or digit join the one before."""
    out: list[str] = []
    for piece in _CLAUSE.findall(answer):
        if not piece:
            continue
        if out and not any(c.isalnum() for c in piece):
            out[-1] += piece
        else:
            out.append(piece)
    return out


@functools.lru_cache(maxsize=200_000)
def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS


def _grade(share: float) -> str:
    return "0" if share == 0 else "low" if share < 0.5 else "half" if share < 0.8 else "high" if share < 1 else "all"


class Question:
    """What the clauses of an answer are compared with."""

    def __init__(self, text: str | None):
        text = text or ""
        self.words = _WORD.findall(text.casefold())
        self.known = set(self.words)
        self.pairs = set(zip(self.words, self.words[1:]))
        votes = languages_of(text, self.words)
        # Several languages may speak for it equally.
        self.allowed = {c for c, n in votes.items() if n == max(votes.values())}
        self.asked = {_names()[w] for w in self.words if w in _names()}
        self.allowed |= self.asked if self.allowed else set()


def features(question: Question, parts: list[str]) -> tuple[Sequence, list[int]]:
    """(feature numbers, words) of each clause."""
    words = [_WORD.findall(p.casefold()) for p in parts]
    whole = "".join(parts)
    flat = [w for ws in words for w in ws]
    whole_votes = languages_of(whole, flat)
    own = max((whole_votes[c] for c in question.allowed), default=0)
    best = whole_votes.most_common(1)[0] if whole_votes else ("", 0)
    drift = "none" if not question.allowed or not best[1] else "own" if best[0] in question.allowed or best[1] <= own else "far" if best[1] >= own + 2 and best[1] >= 1.5 * own else "near"
    total = len(flat)
    asked = sum(w in question.known for w in flat) / max(total, 1)
    shouted = whole.isupper()
    out: Sequence = []
    opens = len(flat) > 1 and flat[:2] == question.words[:2]
    shares = [sum(w in question.known for w in ws) / max(len(ws), 1) for ws in words]
    orders = [sum(p in question.pairs for p in zip(ws, ws[1:])) / max(len(ws) - 1, 1) if len(ws) > 1 else k for ws, k in zip(words, shares)]
    for i, (part, ws, known, order) in enumerate(zip(parts, words, shares, orders)):
        last = i == len(parts) - 1
        n = len(ws)
        votes = languages_of(part, ws)
        same = max((votes[c] for c in question.allowed), default=0)
        other = max((v for c, v in votes.items() if c not in question.allowed), default=0) if question.allowed else 0
        names = [
            "bias", f"size {min(n, 12) // 3}", f"known {_grade(known)}", f"order {_grade(order)}", f"whole {_grade(asked)} {_grade(order)}", f"drift {drift}",
            f"lang {'own' if same > other else 'other' if other > same else 'even'} {drift}", f"short {total < 16} {drift}",
        ]
        if asked >= 0.8:
            names.append(f"mostly asked {_grade(known)} {min(total - round(asked * total), 6)}")
        if i == 0:
            names.append("first")
            if opens:
                names.append("opens as asked")
            if not last:
                names.append(f"first, next {_grade(shares[1])} {_grade(orders[1])} {asked >= 0.7}")
        if any(c.isdigit() for c in part):
            names.append(f"figures {total < 10}")
        if last:
            tail = part.rstrip()
            end = "done" if _DONE.search(tail) else tail[-1:] if tail[-1:] in ",;:-–—" else "bare"
            shape = "list" if _LIST.match(part) or "\n" in whole and _LIST.match(part.lstrip("\n")) else "figure" if re.search(r"\d\S*(?:\s?[^\W\d_]{1,3}|\s?%)?$", tail) else "word"
            dots = re.search(r"(?:\.\.\.|…)$", tail) is not None
            gap = dots and re.search(r"\s(?:\.\.\.|…)$", tail) is not None
            short = re.search(r"\b[^\W\d_]{1,4}\.$", tail) is not None and part[:1] != "\n"
            names += [f"end {end} dots {dots} opens {opens} known {_grade(asked)}"]
            names += ["last", f"end {end}", f"end {end} {shape} {total < 10}", f"end {end} known {_grade(known)} {_grade(asked)}"]
            names += ["dots"] * dots + ["dots apart"] * gap + [f"dots {_grade(asked)}"] * dots + ["abbreviation"] * short
            names.append(f"end {end} shouted {shouted} lower {whole.islower()}")
            if end == "bare" and ws:
                names.append("bare function word" if ws[-1] in _function_words() else "bare word")
        before = ""
        for w in ws:
            if w.isdigit() or w in question.known:
                before = ""
                continue
            names.append("w " + w)
            if before:
                names.append(f"p {before} {w}")
            before = w
        out.append(np.array([_bucket(x) for x in names], np.int64))
    return out, [max(len(w), 1) for w in words]


def is_empty(answer: str | None) -> bool:
    """Null, blank, marks only or a placeholder."""
    if answer is None:
        return True
    bare = answer.strip().strip("[](){}<>\"'.*_- ").casefold()
    return not any(c.isalnum() for c in bare) or bare in PLACEHOLDERS


def verdict(tags: np.ndarray, size: list[int], announced: bool = False) -> str | None:
    """The defect of an answer whose clauses have these tags and numbers of words. A short first clause that only
    announces the next one (``announced``) counts with it."""
    if announced and len(tags) > 1:
        tags = np.concatenate([tags[1:2], tags[1:]])
    n = np.bincount(tags, np.array(size, np.float64), 5)
    total = n.sum()
    if n[ECHO] >= 0.9 * total:
        return "copied"
    if n[REFUSAL] >= 0.5 * total:
        return "refusal"
    if n[FOREIGN] >= 0.5 * (total - n[ECHO]):
        return "other_language"
    return "truncated" if len(tags) and tags[-1] == UNFINISHED else None


class Examples:
    """Training sequences and tags from sampled (question, answer) rows."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.x: list[Sequence] = []
        self.y: list[list[int]] = []
        chance = np.random.default_rng(11)
        texts = [(q, a.strip()) for q, a in rows if not is_empty(a)]
        sound: list[tuple[str, str, str]] = []
        for q, a in texts:
            self._own(q, a, sound)
        by: dict[str, list[str]] = {}
        for code, _, a in sound:
            by.setdefault(code, []).append(a)
        for code, text in SEEDS.items():
            by.setdefault(code, []).extend(text.strip().split(". "))
        for k, (code, q, a) in enumerate(sound):
            kind = k % 6
            if kind < 2 or kind == 5:
                self._cut(q, a, chance)
            if kind == 5:  # a short stump
                self._cut(q, a.split(",")[0], chance)
            if kind == 2:
                self._echo(q, code, k // 6)
            if kind == 3:
                self._refuse(q, code, k // 6, chance)
            if kind == 4:
                far = [c for c in by if c != code and c not in Question(q).allowed]
                if far:
                    code = far[k // 6 % len(far)]
                    pick = by[code][int(chance.integers(len(by[code])))]
                    self._add(q, pick, FOREIGN)
                    # The same answer is sound where the question asks for its language.
                    self._add(f"{q} ({EXONYMS[code].split()[k // 6 % len(EXONYMS[code].split())]})", pick, ANSWER)

    def _add(self, q: str, a: str, tag: int, last: int | None = None, echo: bool = False) -> None:
        question, parts = Question(q), clauses(a)
        if not parts:
            return
        x, _ = features(question, parts)
        y = [tag] * len(parts)
        if echo:
            for i, p in enumerate(parts):
                ws = _WORD.findall(p.casefold())
                pairs = list(zip(ws, ws[1:]))
                if len(ws) > 1 and sum(w in question.known for w in ws) >= 0.9 * len(ws) and sum(p in question.pairs for p in pairs) >= 0.8 * len(pairs):
                    y[i] = ECHO
        if last is not None:
            y[-1] = last
        self.x.append(x)
        self.y.append(y)

    def _own(self, q: str, a: str, sound: list) -> None:
        """A row as it is, if it is clear."""
        question = Question(q)
        words = _WORD.findall(a.casefold())
        new = [w for w in words if w not in question.known]
        votes = languages_of(a, words)
        own = max((votes[c] for c in question.allowed), default=0)
        best = votes.most_common(1)[0] if votes else ("", 0)
        if len(new) <= 1 and len(words) > 3 or a.casefold().rstrip(".?! ") == (q or "").casefold().rstrip(".?! "):
            self._add(q, a, ECHO)
        elif DECLINES.search(a) and len(words) < 45:
            for own in (a, a.upper(), re.sub(r"[.,;:!¡¿?]", "", a.lower()), _OPENINGS[len(self.x) % len(_OPENINGS)] + a):
                self._add(q, own, REFUSAL)
        elif question.allowed and best[0] not in question.allowed and best[1] >= own + 3 and best[1] >= 2 * own:
            self._add(q, a, FOREIGN)
        elif DECLINES.search(a):
            return
        elif _DONE.search(a) and not re.search(r"\s(?:\.\.\.|…)$", a):
            self._add(q, a, ANSWER, echo=len(new) >= 0.15 * len(words))
            if own and len(words) > 8 and len(new) > 3 and not question.asked:
                sound.append((next(iter(question.allowed)), q, a))
        elif _LIST.match(a.rsplit("\n", 1)[-1]) or len(words) < 6 and re.search(r"\d", a):
            self._add(q, a, ANSWER)

    def _cut(self, q: str, a: str, chance: np.random.Generator) -> None:
        """Cut off inside a clause that is not the first third, with or without a mark behind."""
        at = int(chance.integers(max(len(a) // 3, 8), max(len(a) - 4, 9)))
        head = a[:at].rstrip()
        if len(head) < 8 or head[-1] in ".!?…":
            return
        head = head.rstrip(",;:-")
        self._add(q, head + ["", "", "", ",", "-", " …"][int(chance.integers(6))], ANSWER, last=UNFINISHED, echo=True)

    def _echo(self, q: str, code: str, k: int) -> None:
        bare = q.strip().rstrip(".?!").lstrip("¿¡")
        part = bare.split()
        half = part[len(part) // 3 :] if len(part) > 6 else part
        made = [q, bare + ".", q.upper(), f"{q}\n{q}", ASKED.get(code, "") + q, " ".join(part[: max(4, len(part) - 2)]) + "...", BECAUSE.get(code, "") + " ".join(half) + ".", q.lower(), BECAUSE.get(code, "") + " ".join(half[:-2] or half) + "."]
        self._add(q, made[k % len(made)], ECHO)

    def _refuse(self, q: str, code: str, k: int, chance: np.random.Generator) -> None:
        own = [t for c, t in REFUSALS if c == code] or [t for _, t in REFUSALS]
        text = own[k % len(own)]
        style = int(chance.integers(4))
        self._add(q, [text, text.upper(), re.sub(r"[.,;!]", "", text.lower()), text][style], REFUSAL)


def fit(rows: list[tuple[str, str]]) -> ConditionalField:
    made = Examples(rows)
    return ConditionalField(5, BUCKETS).fit(made.x, made.y)


def fitted(df: DataFrame) -> ConditionalField:
    """Fitted on a bounded sample of the table."""
    rows = bounded_texts(df, "id", "answer", "question", rows=TRAIN_ROWS, chars=TRAIN_CHARS, longest=LONG_CHARS)
    return fit([(r["question"] or "", r["answer"]) for r in rows])


def judge(field: ConditionalField, questions: list[str | None], answers: list[str | None]) -> list[str | None]:
    """The defect of every pair, None where there is none."""
    out: list[str | None] = [None] * len(answers)
    at, xs, sizes = [], [], []
    for i, (q, a) in enumerate(zip(questions, answers)):
        if is_empty(a):
            out[i] = "empty"
            continue
        parts = clauses(a.strip())
        x, size = features(Question(q), parts)
        at.append(i)
        xs.append(x)
        sizes.append((size, size[0] <= 4 and parts[0].rstrip().endswith((":", "："))))
    for i, tags, (size, announced) in zip(at, field.decode(xs), sizes):
        out[i] = verdict(tags, size, announced)
    return out


def pair_defects(df: DataFrame, field: ConditionalField | None = None) -> DataFrame:
    """(id, defect) of every defective pair. Each batch of rows is judged on its own; only result rows are shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(field or fitted(df))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, questions, answers = (batch.column(i).to_pylist() for i in range(3))
            found = [(i, d) for i, d in zip(ids, judge(shared.value, questions, answers)) if d]
            cols = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["id", "defect"])

    rows = df.where("id is not null").select(F.col("id").cast("string"), "question", "answer")
    return rows.mapInArrow(scan, "id string, defect string").groupBy("id").agg(F.min("defect").alias("defect"))

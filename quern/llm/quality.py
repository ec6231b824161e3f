"""Per-record text statistics and the kind of text they show: prose, list, table or junk.

:func:`statistics` measures many texts at once: shares of characters, of words, and of lines and ink (characters
without outer white space) that show a mark of shape, such as a list marker, cell borders, a closing mark or common
words. Gradient-boosted trees learn from these measures what :class:`LineKinds`, a set of hand-written rules for single
lines, says of the clear texts of a bounded sample; the rules abstain elsewhere, are no input of the trees and are not
used when the table is judged. A fifth of the labelled records and the hand-checked texts of :func:`holdout` calibrate
the probabilities.

Common words are those that occur in at least :data:`COMMON_SHARE` of all records, counted over the whole table with
partial counts in each task; their number is bounded by that share. Model and words are broadcast; the texts are read
once for the words, once for the sample and once to be judged, and never shuffled.

Defined cases: null, empty and blank texts have no kind and no bad count, and statistics of 0; a null stored
count is never bad; an id delivered twice counts once; an empty table gives an empty result; extra columns are
ignored; ties between kinds go to prose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.boost import BoostedTrees
from quern.llm.chars import slices
from quern.llm.lines import Lines, Member, common_words, word_records
from quern.llm.sampling import bounded_texts
from quern.runtime import written

KINDS = ["prose", "list", "table", "junk"]
#: Bounds of the training sample. Longer texts are judged like all others but not learned from.
TRAIN_ROWS, TRAIN_CHARS, LONG_CHARS = 6_000, 12_000_000, 60_000
COMMON_SHARE = 0.004
#: Characters whose lines are held in arrays at once.
RUN_CHARS = 600_000
TOLERANCE = 0.05
#: Marks a line may show; each gives a share of the ink and a share of the lines.
MARKS = [
    "marked", "leaders", "pipes", "tabs", "wide", "semicolons", "commas", "long", "short", "ended_long", "sentence", "no_common", "strange", "digits",
    "unlettered", "symbols", "long_word", "capitals", "unspaced", "dashed", "speech", "tiny_tokens", "mangled", "links", "few_tokens", "marked_ended", "names", "repeated",
]
STATS = [
    "char_count", "word_count", "line_count", "mean_word_length", "mean_line_length", "letter_share", "digit_share",
    "upper_share", "symbol_share", "noise_share", "ended_share", "common_share", "longest_share", "repeat_share",
    *(f"{m}_ink" for m in MARKS), *(f"{m}_lines" for m in MARKS),
]
#: What the trees see: sizes themselves are no evidence of kind.
SEEN = [i for i, n in enumerate(STATS) if not n.endswith("_count")]


class LineKinds:
    """Coarse kinds of the lines of a batch by rule, for weak labels: ``row``, ``junk``, ``prose``, ``item``; the rest is neither."""

    def __init__(self, lines: Lines):
        c = lines.c
        some = ~lines.blank
        chars = np.maximum(lines.chars, 1)
        spaced, unspaced = lines.spaced_words, lines.unspaced
        not_space = np.append((c[1:] != 32) & (c[1:] != 10), False)
        tight_semi = lines.per_line((c == 0x3B) & np.append(c[1:] != 32, False))
        tight_comma = lines.per_line((c == 0x2C) & np.append(c[1:] != 32, False))
        wordy = (lines.common >= 0.4 * np.maximum(spaced, 1)) & (spaced >= 6)
        latin = np.bincount(lines.w_line, lines.w_spaced & (lines.low[lines.w_start] < 0x250), len(chars))
        latin_strange = np.bincount(lines.w_line, lines.w_spaced & (lines.low[lines.w_start] < 0x250) & ~lines.w_cap & ~lines.w_common, len(chars))

        h, wl = lines.w_hash, lines.w_line
        again = np.zeros(len(h), bool)
        for lag in range(1, 5):
            again[lag:] |= (h[lag:] == h[:-lag]) & (wl[lag:] == wl[:-lag])
        repeats = np.bincount(wl, again, len(chars))
        repeated = (repeats >= 0.6 * np.maximum(lines.words, 1)) & (lines.words >= 6)
        other_script = (spaced - latin >= 4) & (spaced - latin >= 0.5 * spaced)
        noisy = (lines.letters + lines.digits < 0.62 * chars) & (lines.odd + lines.noise > 0.12 * chars) & (chars >= 10) & (unspaced < 8) & ~other_script
        coded = (tight_semi + tight_comma < 2) & (lines.longest >= 40) & (unspaced < 5) & (lines.longest > 0.5 * chars) & ((lines.digits + lines.uppers > 0.2 * chars) | (lines.letters < 0.5 * chars)) & ~other_script
        bytes_ = (lines.tokens >= 8) & (chars < 3.9 * lines.tokens) & (unspaced < 5) & (lines.common <= 0.2 * lines.tokens) & (lines.digits > 0.2 * chars) & (lines.pipes < 3)
        gibberish = (latin_strange > 0.5 * latin) & (lines.common < 0.25 * latin) & (latin >= 5) & (lines.caps <= 0.3 * lines.alpha_words)
        mangled = (lines.per_line(np.isin(c, [ord(x) for x in "ÃÂï¿½€œ�"])) >= 0.1 * chars) & (chars >= 10)
        piped = (lines.pipes >= 2) & (lines.first_char == 0x7C) & (c[lines.tail] == 0x7C) & (lines.letters + lines.digits + lines.per_line(c == 0x2D) > 0.25 * chars)
        noisy &= ~piped
        bytes_ &= ~piped
        self.junk = some & (noisy | coded | bytes_ | repeated | mangled)
        self.repeats = repeats
        delimited = piped | (lines.tabs >= 2) | (lines.wide >= 2) | (tight_semi >= 2) | (tight_comma >= 2)
        cells = np.maximum.reduce([lines.tabs, lines.wide, tight_semi, tight_comma]) + 1
        delimited &= piped | (lines.tokens <= 4 * cells)
        self.row = some & ~self.junk & delimited & ~wordy & (unspaced < 25)
        self.junk |= some & gibberish & ~self.row
        # A short line that closes with two names, perhaps a figure: an entry without a mark.
        name = lines.w_cap & ~lines.w_common & lines.w_alpha
        last_alpha = np.zeros(len(chars), np.int64) - 1
        at = np.nonzero(lines.w_alpha)[0]
        np.maximum.at(last_alpha, lines.w_line[at], at)
        ok = last_alpha >= 1
        la = np.maximum(last_alpha, 1)
        tail = ok & name[la] & (name[la - 1] & (lines.w_line[la - 1] == np.arange(len(chars)))) if len(name) > 1 else ok
        link = lines.per_line(np.isin(c, (0xBB, 0x3E, 0x7C, 0xA9)) & True) > 0
        long_enough = ((unspaced >= 18) & (lines.ended | (chars > 40))) | (other_script & (spaced >= 5) & (lines.ended | (chars > 80)))
        sentence = (spaced >= 7) & (lines.common >= 0.35 * spaced) & (lines.ended | (chars > 100))
        speech = lines.em_dash | (lines.dash_item & lines.ended & (spaced >= 7) & (lines.common >= 0.45 * spaced))
        marker = lines.marker & (lines.first_char != 0xBB)
        self.prose = some & ~self.row & ~self.junk & ~(tail & (spaced <= 12) & (chars < 90) & ~link) & (long_enough | sentence) & (~marker | speech)
        foreign = ((spaced - latin >= 2) & (spaced - latin >= latin)) | ((unspaced >= 4) & ~lines.ended)
        entry = (tail & (chars < 110) | foreign & (chars < 80) & ~self.prose) & ~link
        self.item = some & ~self.row & ~self.junk & ~self.prose & (marker | (lines.leaders > 0) | entry)
        self.some = some


def _repeats(lines: Lines) -> np.ndarray:
    """Words of each line that stood up to four words before in it."""
    h, wl = lines.w_hash, lines.w_line
    again = np.zeros(len(h), bool)
    for lag in range(1, 5):
        again[lag:] |= (h[lag:] == h[:-lag]) & (wl[lag:] == wl[:-lag])
    return np.bincount(wl, again, len(lines.chars))


def _marks(lines: Lines, repeats: np.ndarray) -> list[np.ndarray]:
    """The marks of :data:`MARKS` for every line."""
    c = lines.c
    chars, spaced, words = np.maximum(lines.chars, 1), np.maximum(lines.spaced_words, 1), np.maximum(lines.words, 1)
    tight = lambda code: lines.per_line((c == code) & np.append(c[1:] != 32, False)) >= 2
    name = lines.w_cap & ~lines.w_common & lines.w_alpha
    last = np.full(len(chars), -1)
    at = np.nonzero(lines.w_alpha)[0]
    np.maximum.at(last, lines.w_line[at], at)
    end = np.maximum(last, 1)
    names = (last >= 1) & name[end] & name[end - 1] & (lines.w_line[end - 1] == np.arange(len(chars))) & (lines.spaced_words <= 12) if len(name) > 1 else np.zeros(len(chars), bool)
    return [
        lines.marker, lines.leaders > 0, lines.pipes >= 2, lines.tabs >= 2, lines.wide >= 2, tight(0x3B), tight(0x2C), lines.chars > 100, lines.chars < 60, lines.ended & (lines.chars > 100),
        (lines.spaced_words >= 7) & (lines.common >= 0.35 * spaced) & lines.ended, (lines.common == 0) & (lines.spaced_words >= 2), (lines.strange > 0.5 * spaced) & (lines.spaced_words >= 5),
        lines.digits > 0.2 * chars, lines.letters < 0.5 * chars, (lines.odd + lines.noise > 0.12 * chars) & (lines.chars >= 10), (lines.longest >= 40) & (lines.longest > 0.5 * chars) & (lines.unspaced < 5),
        lines.caps > 0.6 * np.maximum(lines.alpha_words, 1), lines.unspaced >= 18, lines.dash_item, lines.em_dash, (lines.tokens >= 8) & (lines.chars < 3.9 * lines.tokens) & (lines.unspaced < 5),
        (lines.per_line(np.isin(c, [ord(x) for x in "ÃÂï¿½€œ�"])) >= 0.1 * chars) & (lines.chars >= 10), lines.per_line(np.isin(c, (0xBB, 0x3E, 0x7C, 0xA9))) > 0, lines.tokens <= 4,
        lines.marker & lines.ended, names, (repeats >= 0.6 * words) & (lines.words >= 6),
    ]


def statistics(lines: Lines) -> np.ndarray:
    """(texts x STATS) of the texts of ``lines``."""
    if not lines.n_docs:
        return np.zeros((0, len(STATS)))
    by = lines.by_doc
    some = ~lines.blank
    chars = np.diff(lines.border) - 1
    ink, count = np.maximum(by(lines.chars), 1), by(some)
    letters, spaced = by(lines.letters), by(lines.spaced_words)
    # Words count as common by their share among words of spaced scripts; texts without such words count as common.
    common = np.where(spaced >= 5, by(lines.common) / np.maximum(spaced, 1), 1.0)
    longest = np.zeros(lines.n_docs)
    np.maximum.at(longest, lines.doc, lines.longest)
    repeats = _repeats(lines)
    marks = [m & some for m in _marks(lines, repeats)]
    return np.stack(
        [
            chars, lines.doc_tokens, count,
            letters / np.maximum(by(lines.alpha_words), 1), ink / np.maximum(count, 1), letters / ink, by(lines.digits) / ink,
            by(lines.uppers) / np.maximum(letters, 1), by(lines.odd) / ink, by(lines.noise) / ink, by(np.where(lines.ended, lines.chars, 0)) / ink,
            common, np.minimum(longest / ink, 1), by(repeats) / np.maximum(by(lines.words), 1),
            *(by(np.where(m, lines.chars, 0)) / ink for m in marks), *(by(m) / np.maximum(count, 1) for m in marks),
        ],
        1,
    ).astype(np.float64)


def weak_labels(lines: Lines) -> np.ndarray:
    """Class numbers of the texts that the line rules find clear, -1 for the others."""
    if not lines.n_docs:
        return np.zeros(0, np.int64)
    kinds = LineKinds(lines)
    by = lines.by_doc
    ink = np.maximum(by(lines.chars), 1)
    prose, item, row, junk = (by(np.where(k, lines.chars, 0)) / ink for k in (kinds.prose, kinds.item, kinds.row, kinds.junk))
    y = np.full(lines.n_docs, -1)
    y[(prose > 0.35) & (np.maximum(np.maximum(item, row), junk) < 0.5 * prose)] = 0
    y[(prose <= 0.35) & (np.maximum(np.maximum(item, row), junk) < 0.1)] = 0
    y[(item > 0.5) & (np.maximum(np.maximum(prose, row), junk) < 0.6 * item) & (by(kinds.item) >= 4)] = 1
    y[(row > 0.5) & (np.maximum(np.maximum(prose, item), junk) < 0.6 * row) & (by(kinds.row) >= 3)] = 2
    y[(junk > 0.6) & (prose < 0.25)] = 3
    return y


def holdout() -> tuple[list[str], list[int]]:
    """Hand-checked texts and their class numbers."""
    prose = [
        "The mill closed in 1931. Nobody in the valley had expected it, and the workers learned of it from a note on the door.",
        "Menu\nHome\nSearch\nThe river rose slowly that spring. By May the lower meadow was a lake, and the road to the village had gone.\nShare this page",
        "O professor chegou cedo e abriu as janelas da sala. Depois escreveu no quadro a lista dos alunos que iriam ao museu.",
        "— Quem vem lá?\n— Sou eu, o filho do moleiro, e trago notícias da cidade que todos querem ouvir.\n— Então entra e fecha a porta.",
        "El método se apoya en una idea simple: medir dos veces. f(x) = 2x + 1\nLa segunda medida corrige los errores de la primera.",
        "Nous partirons demain. La voiture est prête, les livres sont dans la caisse, et le chien dort déjà sous la table.",
        "Der alte Turm steht noch am Ufer. Im Sommer kommen viele Leute, im Winter bleibt er leer und kalt.",
        "旧灯塔仍然立在河边。夏天有很多人来，冬天它又空又冷。",
        "Старый маяк всё ещё стоит на берегу. Летом сюда приезжает много людей, а зимой он пуст.",
    ]
    lists = [
        "Expedition members\n- Anna Brenck\n- Tomas Ulvar\n- Ilse Morrand\n- Piet Sorring\n- Karla Dune",
        "1. Apples\n2. Pears\n3. Plums\n4. Quinces\n5. Medlars\n6. Cherries",
        "a) Rua Torlan;\nb) Rua Medvi;\nc) Rua Saltra;\nd) Rua Brinco;\ne) Rua Goldra;",
        "Vilmar Sostra ........ 12\nTenna Golfri ........ 45\nPardo Mellin ........ 78\nBrisa Conforta ........ 91",
        "Vilmar Sostra, 12,5\nTenna Golfri\nPardo Mellin.\nBrisa Conforta, 9,1\nLodo Ferrante\nSalva Minetti",
    ]
    rows = [
        "| name | size | year |\n|---|---|---|\n| Torlan Medvi | 23 | 1931 |\n| Saltra Brinco | 4.5 | - |\n| Goldra Penn | 7 | 2001 |",
        "alpha;beta;gamma\nTorlan Medvi;12;3.4\nSaltra Brinco;;8\nGoldra Penn;99;-",
        "alpha\tbeta\tgamma\nTorlan\t12\t3.4\nSaltra\t5\t8\nGoldra\t99\t7",
        "alpha   beta   gamma\nTorlan   12   3.4\nSaltra   5   8\nGoldra   99   7",
        "alpha,beta,gamma\nTorlan,12,3.4\nSaltra,5,8\nGoldra,99,7",
    ]
    junk = [
        "qX7" * 3 + "".join("aZ9kQ3+/bT"[(i * 7) % 10] for i in range(300)),
        "0x1a2b3c4d: 0f 3e 9a 77 c1 00 fe 12 34 ab cd ef 01 02 03 04\n0x1a2b3c5d: 11 3e 9a 77 c1 00 fe 12 34 ab cd ef 01 02 03 99",
        "Torlan Medvi " * 40,
        "{]=~*#@%$^&|\\<>{}[]~^*+=_#@a]{b=*~}c|\\^" * 6,
        "qwz xkjv bplm trrw zzok fgh qpw mnbv lkjh gfd wqe rtzx vbn qmpl zxk wjrq\nplmk jnhb vgtf rdcx zsae wqop lkmj nhbg vfcd xsza qwsx edcr fvtg byhn ujmk",
    ]
    texts = [*prose, *lists, *rows, *junk]
    return texts, [0] * len(prose) + [1] * len(lists) + [2] * len(rows) + [3] * len(junk)


class QualityModel:
    """The fitted trees and the corpus's common words."""

    def __init__(self, trees: BoostedTrees, common: np.ndarray):
        self.trees, self.common = trees, common

    def member(self) -> Member:
        return Member(self.common)

    def kinds(self, stats: np.ndarray) -> np.ndarray:
        """Class number of each text: the likeliest, 0 for texts without any character."""
        p = self.trees.predict(stats[:, SEEN])
        return np.where(stats[:, STATS.index("line_count")] > 0, p.argmax(1) if len(p) else 0, 0)


def mixtures(texts: list[str], y: np.ndarray, most: int = 300) -> tuple[list[str], list[int]]:
    """(texts, class numbers): lists and tables of the sample with prose lines of other texts put before or behind
    them, captions, openings and closing sentences that the corpus shows too rarely to learn from. The class is known
    from how the text was made: that of the part with more characters, none where they are nearly equal."""
    lines = [p for t in (texts[i] for i in np.nonzero(y == 0)[0][:most]) for p in t.split("\n") if len(p) > 90]
    out, labels = [], []
    for n, i in enumerate(np.nonzero((y == 1) | (y == 2))[0][:most]):
        own = texts[i].split("\n")
        body = own[: max(4, min(len(own), 4 + n % 12))]
        size = sum(map(len, body))
        for j in range(3 if lines else 0):
            line = lines[(7 * n + j) % len(lines)]
            if not 0.8 * size < len(line) < 1.25 * size:
                out.append("\n".join([line, *body] if j % 2 else [*body, line]))
                labels.append(int(y[i]) if size > len(line) else 0)
    return out, labels


def fit(texts: list[str], common: np.ndarray | None = None) -> QualityModel:
    """Fit on a sample of the corpus (see :func:`training_texts`); ``common``: hashes of the common words."""
    common = common_words(texts, COMMON_SHARE) if common is None else common
    member = Member(common)
    xs, ys = [np.zeros((0, len(STATS)))], [np.zeros(0, np.int64)]
    for _, run in slices(texts, RUN_CHARS):
        lines = Lines(run, member)
        xs.append(statistics(lines))
        ys.append(weak_labels(lines))
    x, y = np.concatenate(xs), np.concatenate(ys)
    mixed, labels = mixtures(texts, y)
    known, answers = holdout()
    # The holdout's own words are common ones for its statistics: it must not depend on the corpus.
    own = Member(np.unique(np.concatenate([common, _holdout_words(known)])))
    hx, hy = statistics(Lines(known, own)), np.array(answers)
    clear = np.nonzero(y >= 0)[0]
    held = clear[clear % 5 == 0]
    learned = clear[clear % 5 != 0]
    # The hand-checked texts stand in for kinds that a small table hardly shows.
    rare = np.bincount(y[learned], minlength=4)[hy] < 5
    fx = np.concatenate([x[learned], *[statistics(Lines(run, member)) for _, run in slices(mixed, RUN_CHARS)], np.repeat(hx[rare], 5, 0)])
    fy = np.concatenate([y[learned], np.array(labels, np.int64), np.repeat(hy[rare], 5)]).astype(np.int64)
    cx, cy = np.concatenate([x[held], hx[~rare]]), np.concatenate([y[held], hy[~rare]])
    trees = BoostedTrees(4, rounds=40, depth=4).fit(fx[:, SEEN], fy)
    return QualityModel(trees.calibrate(cx[:, SEEN], cy) if len(cy) else trees, common)


def _holdout_words(texts: list[str]) -> np.ndarray:
    lines = Lines(texts[:9])
    return lines.w_hash[lines.w_alpha & ~lines.w_cap]


def corpus_words(df: DataFrame, share: float = COMMON_SHARE) -> np.ndarray:
    """Sorted hashes of the words that occur in at least ``share`` of the table's texts (at least three)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, 0
        schema = pa.schema([("word", pa.int64()), ("records", pa.int64())])

        def merged():
            word, of = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            return word, np.bincount(of, np.concatenate([n for _, n in held]), len(word)).astype(np.int64)

        for batch in batches:
            texts = batch.column(0).to_pylist()
            total += len(texts)
            for _, run in slices(texts, RUN_CHARS):
                held.append(word_records(run))
                size += len(held[-1][0])
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], schema=schema)
                    held, size = [], 0
        if held:
            word, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total])], schema=schema)

    counts = df.where("text is not null and text <> ''").select("text").mapInArrow(count, "word long, records long").groupBy("word").agg(F.sum("records").alias("records")).where("records >= 3 or word is null")
    # Most words are far below any share: only those of at least three records are left, and the total tells the bound.
    counts = written(counts, "words")
    total = counts.where("word is null").first()
    least = max(3, share * (total["records"] if total else 0))
    return np.sort(np.array([r["word"] for r in counts.where("word is not null").where(F.col("records") >= least).toLocalIterator()], np.int64).view(np.uint64))


def training_texts(df: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> list[str]:
    """At most ``rows`` texts of at most ``chars`` characters together, none over :data:`LONG_CHARS`."""
    return [r["text"] for r in bounded_texts(df, "id", "text", rows=rows, chars=chars, longest=LONG_CHARS)]


def fitted(df: DataFrame) -> QualityModel:
    return fit(training_texts(df), corpus_words(df))


def _scan(df: DataFrame, columns: list[str], schema: str, model: QualityModel, each, empty: bool = False) -> DataFrame:
    """One pass over (id, text, columns): ``each(lines, stats, batch rows) -> dict of output columns``; null and
    empty texts only where ``empty`` is set."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        member = own.member()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, run in slices(texts, RUN_CHARS):
                lines = Lines(run, member)
                yield each(own, lines, statistics(lines), batch.slice(first, len(run)))

    rows = df.select("id", "text", *columns).where("id is not null")
    return (rows if empty else rows.where("text is not null and text <> ''")).mapInArrow(scan, schema)


def text_kinds(df: DataFrame, model: QualityModel | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """(id, kind): list, table, junk and bad_count of each record."""
    model = model or fitted(df)

    def each(own: QualityModel, lines: Lines, stats: np.ndarray, rows: pa.RecordBatch) -> pa.RecordBatch:
        kind = own.kinds(stats)
        bad = np.zeros(len(kind), bool)
        for name, col in (("char_count", 2), ("word_count", 3)):
            stored = rows.column(col).to_numpy(zero_copy_only=False).astype(np.float64)
            true = stats[:, STATS.index(name)]
            bad |= ~np.isnan(stored) & (np.abs(stored - true) > tolerance * true)
        odd, wrong = np.nonzero(kind > 0)[0], np.nonzero(bad)[0]
        ids = pa.concat_arrays([rows.column(0).take(pa.array(odd)), rows.column(0).take(pa.array(wrong))])
        names = [KINDS[k] for k in kind[odd]] + ["bad_count"] * len(wrong)
        return pa.RecordBatch.from_arrays([ids.cast(pa.string()), pa.array(names, pa.string())], names=["id", "kind"])

    return _scan(df, ["char_count", "word_count"], "id string, kind string", model, each).distinct()


def text_statistics(df: DataFrame, model: QualityModel | None = None) -> DataFrame:
    """(id, every statistic, probability of each kind) of each record; all are 0 for null and empty texts."""
    model = model or fitted(df)
    schema = ", ".join(["id string", *(f"{n} double" for n in STATS), *(f"p_{k} double" for k in KINDS)])

    def each(own: QualityModel, lines: Lines, stats: np.ndarray, rows: pa.RecordBatch) -> pa.RecordBatch:
        some = stats[:, :1] > 0
        stats, p = np.where(some, stats, 0.0), np.where(some, own.trees.predict(stats[:, SEEN]), 0.0)
        cols = [rows.column(0).cast(pa.string()), *(pa.array(stats[:, i]) for i in range(stats.shape[1])), *(pa.array(p[:, i]) for i in range(4))]
        return pa.RecordBatch.from_arrays(cols, names=["id", *STATS, *(f"p_{k}" for k in KINDS)])

    return _scan(df, [], schema, model, each, empty=True).dropDuplicates(["id"])

"""Main content of pages by a vote of each site on the paths of its containers.

The tables carry text without tags, so a container is a line, and its path is what a tag-class path is to a tag:
the line with digits, the site's own name and all words that are rare in the site masked, cut at the first
separator ("leia também: *", "by the archive S staff"). The steps:

1. ``known words``: the words that stand in at least :data:`KNOWN_SHARE` of the site's records (in lines short
   enough to have a path). The rest, names above all, is masked.
2. ``score``: every container gets a score from its shape, its neighbours and a few seed words (0 content, 1 furniture).
3. ``vote``: per site and path, the share of records that carry the path and the mean score decide together. A site
   with few records leans on the share the path has in the other sites that use it.
4. ``re-extract``: the texts are read again; lines on a winning path are furniture, all others main content.

Counts are added up inside each task before they are shuffled, so a site with a third of all records costs one row a
task and path. What the votes leave behind (words and paths of each site) is broadcast while it is under
:data:`BOOK_BYTES`; beyond, texts and site rows meet in salted partitions sorted by site.

Defined cases: null, empty and blank texts have no furniture; blank lines are never furniture; lines of more than
:data:`PATH_CHARS` characters have no path and are content; an id delivered twice counts once in the result (in the
votes as often as delivered); records without spider_name belong to the site of their url, or to one nameless
site; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.runtime import written

PATH_CHARS, HEAD_CHARS = 260, 70
KNOWN_SHARE, KNOWN_LEAST = 0.01, 3
#: Share of a site's records from which a path of middling score is furniture, and the records a thin site borrows.
USUAL_SHARE, BORROWED = 0.05, 8.0
SCORE_WEIGHT = 4.0
BOOK_BYTES = 64 << 20
SALTS = 64
#: Rows a task keeps before it hands on its partial counts.
HELD = 200_000

#: Seed words of furniture, as evidence beside shape and votes.
SEEDS = re.compile(
    r"cookie|©|\bcopyright\b|\btags?\b|\betiquetas\b|\bmots-clés\b|\bpalavras-chave\b|\bpalabras clave\b|\bkeywords\b|\bschlagw|\bparole chiave\b"
    r"|como citar|cómo citar|how to cite|pour citer|comment citer|zitierweise|come citare|\bcoment[aá]rios?\b|\bcomments?\b|\bcommentaires?\b|\bkommentar|\bcommenti?\b"
    r"|\bshare\b|compartilh|partag|comparta|\bteilen\b|condividi|newsletter|boletim|bolet[ií]n|\bdigest\b|\bassine\b|suscr[ií]b|subscribe|abonnez|\babonnieren\b|iscriviti|recevez la|reciba el"
    r"|advert|anúncio|\banuncio\b|publicid|publicité|\bannonce\b|\banzeige\b|\bpubblicit|leia também|lea también|read also|à lire aussi|veja mais|ver más|see more|voir aussi|mais lidas|más le[ií]das|most read|les plus lus"
    r"|continues below|continua (?:após|depois)|sigue después|suite après|página \d|\bpage \d|\bpág\. ?\d|\bmen[uú]\b|voltar ao topo|volver arriba|back to top|haut de page|skip to|ir para o|ir al contenido|aller au contenu|versão para impressão|versión para imprimir|version imprimable|printer-friendly"
    r"|\bdigitali[zs]|\bscanned\b|\bnumérisé|gerado pelo|generated by|généré par|atualizado em|actualizado el|updated on|mis à jour|aggiornato il|aktualisiert am"
    r"|^por \w+[^.]*$|^by \w+[^.]*$|^par \w+[^.]*$|^text[oe]? (by|de|di|von) \w|especial para o|^da redação|\bstaff$|leituras|\breads\b|lecturas|\blectures de\b|direitos reservados|derechos reservados|droits réservés|rights reserved"
    r"|reproduzido desde|quoted with credit|citarse con|cités avec mention|apoio:|\bapoya:|supported by|avec le soutien|\bv(ol)?\. ?\d+, (n|no|núm)[.°º]|sign in|se connecter|entrar ou criar|iniciar sesión"
)
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[^\w\s]|_")
_WORD = re.compile(r"[^\W\d_]+")
_SEPARATORS = frozenset(":>»|/•·–—-")
_OPENERS, _LEADS = frozenset("©☰«»|›→▸"), frozenset("©☰»›→▸")
_ENDED = re.compile(r"[.!?…。！？।؟][\"'”’»)\]]*$")
_ITEM = re.compile(r"^(?:[-*•–—▪◦●]\s|\d{1,3}[.)]\s|\(?[^\W\d_][.)]\s)")
_WIDE = re.compile(r"\s{2,}")


def site_column(df: DataFrame) -> Column:
    """The site of a record: its spider_name, else the host of its url, else the nameless site."""
    host = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[a-z]+://([^/?#:]+)", 1) if "url" in df.columns else F.lit("")
    return F.coalesce(F.when(F.trim("spider_name") != "", F.trim("spider_name")), host).alias("site")


def own_words(site: str) -> frozenset[str]:
    """The words of a site's name (``fapella_pt`` and ``www.fapella.example`` give ``fapella``)."""
    return frozenset(w for w in _WORD.findall(site.casefold()) if len(w) > 3 and w not in ("example",))


class Site:
    """What is known of a site: its name's words, known words and winning paths."""

    def __init__(self, name: str, words: list[str] | None, paths: list[str] | None):
        self.own, self.words, self.paths = own_words(name), frozenset(words or ()), frozenset(paths or ())
        self.seen: dict[str, tuple[str, str | None, float]] = {}

    def path(self, line: str) -> tuple[str, str | None, float]:
        """(path, path of the first of several items set wide apart, score without regard to neighbours) of a line that is not blank."""
        found = self.seen.get(line)
        if found is None:
            if len(self.seen) > 50_000:
                self.seen.clear()
            plain = " ".join(line.split()).casefold()
            path, score = self._path(plain)
            parts = _WIDE.split(line.strip(), 1)
            wide = "~ " + self._path(parts[0].casefold())[0] if len(parts) > 1 and _WIDE.search(parts[1]) else None
            found = self.seen[line] = (path, wide, score)
        return found

    def wins(self, line: str) -> bool:
        path, wide, _ = self.path(line)
        return path in self.paths or wide in self.paths

    def _path(self, plain: str) -> tuple[str, float]:
        out: list[str] = []
        own = words = length = 0
        open_ = True
        for token in _TOKEN.findall(plain):
            first = token[0]
            if first.isalpha():
                if token in self.own:
                    token, own = "S", own + 1
                elif token in self.words:
                    words += len(token) > 1
                else:
                    token = "N"
            elif first.isdigit():
                token = "0"
            if open_:
                if not (out and out[-1] == token and token in "N0.-="):
                    out.append(token)
                    length += len(token) + 1
                if token in _LEADS if len(out) == 1 else token in _SEPARATORS and words and length <= HEAD_CHARS:
                    out.append("*")
                    open_ = False
        score = 0.5
        if not words:
            # Names alone say nothing of a template and never win; figures and marks alone seldom do.
            score = -9.0 if "N" in out else 0.1
        else:
            if own:
                score += 0.3
            if out[0] in _OPENERS:
                score += 0.2
            if len(plain) <= 160 and SEEDS.search(plain):
                score += 0.35
        if _ITEM.match(plain):
            score -= 0.3
        if plain.count(" ") > 11 and _ENDED.search(plain) and not own:
            score -= 0.6  # a sentence: only where most of the site's pages carry it
        return " ".join(out), score


def _containers(site: Site, text: str) -> list[tuple[int, str, float]]:
    """(line number, path, score) of every container that has a path."""
    out = []
    lines = text.split("\n")
    kind = []  # 0 blank, 1 short, 2 running text
    for line in lines:
        size = len(line)
        kind.append(0 if not line or line.isspace() else 2 if size > 100 and (size > PATH_CHARS or _ENDED.search(line)) else 1)
    solid = [i for i, k in enumerate(kind) if k]
    for at, i in enumerate(solid):
        if len(lines[i]) > PATH_CHARS:
            continue
        path, wide, score = site.path(lines[i])
        before = kind[solid[at - 1]] if at else 0
        after = kind[solid[at + 1]] if at + 1 < len(solid) else 0
        if kind[i] == 1:
            if after == 2:  # in front of running text: a heading's place
                score -= 0.15
            elif not after and before:  # the last line
                score += 0.1
            elif before == 1 and after == 1:
                score += 0.05
        out.append((i + 1, path, score))
        if wide:
            out.append((i + 1, wide, score))
    return out


_COUNTS = "site string, key string, records long, score double"


def _partial(sums: dict) -> pa.RecordBatch:
    cols = list(zip(*((s, k, n, t) for (s, k), (n, t) in sums.items())))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.float64()))], names=["site", "key", "records", "score"])


def rows_of(df: DataFrame, *columns: str) -> DataFrame:
    """(id, site, text, *columns) of the records that have an id and a text."""
    some = (F.col("text").isNotNull()) & (F.col("text") != "") & F.col("id").isNotNull()
    return df.where(some).select(F.col("id").cast("string").alias("id"), site_column(df), "text", *columns)


def _known_words(rows: DataFrame) -> DataFrame:
    """(site, word, records) of the known words, and (site, "", records) of all records."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = defaultdict(lambda: [0, 0.0])
        for batch in batches:
            for site, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {""}
                for line in text.split("\n"):
                    if line and len(line) <= PATH_CHARS:
                        words.update(_WORD.findall(line.casefold()))
                for w in words:
                    sums[site, w][0] += 1
            if len(sums) > HELD:
                yield _partial(sums)
                sums.clear()
        if sums:
            yield _partial(sums)

    counts = rows.select("site", "text").mapInArrow(count, _COUNTS).groupBy("site", "key").agg(F.sum("records").alias("records"))
    # A word too rare for any share is gone before the counts meet their site's total.
    counts = written(counts.where((F.col("records") >= KNOWN_LEAST) | (F.col("key") == "")), "site-words")
    total = counts.where("key = ''").select("site", F.col("records").alias("total"))
    known = counts.where("key <> ''").join(total, "site").where(F.col("records") >= F.greatest(F.lit(KNOWN_LEAST), KNOWN_SHARE * F.col("total")))
    return known.groupBy("site").agg(F.collect_list("key").alias("words")).join(total, "site", "right")


def _winners(counts: DataFrame) -> DataFrame:
    """(site, paths): the paths whose log-odds of being furniture, from share and mean score, are not negative.

    ``counts``: (site, key, records, score) with all records of the site under key "".
    """
    total = counts.where("key = ''").select("site", F.col("records").alias("total"))
    votes = counts.where("key <> ''").join(total, "site")
    everywhere = votes.groupBy("key").agg(F.sum("records").alias("_all"), F.sum("total").alias("_of"))
    others, of = F.col("_all") - F.col("records"), F.col("_of") - F.col("total")
    usual = F.when(of > 0, F.least(others / of, F.lit(0.25))).otherwise(F.lit(0.02))
    share = (F.col("records") + BORROWED * usual) / (F.col("total") + BORROWED)
    z = SCORE_WEIGHT * (F.col("score") / F.col("records") - 0.5) + F.log(share / USUAL_SHARE)
    return votes.join(everywhere, "key").where(z >= 0).groupBy("site").agg(F.collect_list("key").alias("paths"))


class Book:
    """The sites' words and paths, broadcast or met in salted partitions; ``scan`` maps texts with their :class:`Site`."""

    def __init__(self, table: DataFrame):
        self.table = table
        spark = table.sparkSession
        size = table.select(F.sum(F.length(F.to_json(F.struct(*[c for c in ("words", "paths") if c in table.columns]))) + F.length("site") + 64)).first()[0] or 0
        self.small = None
        if size <= BOOK_BYTES:
            self.small = spark.sparkContext.broadcast({r["site"]: (r["words"], r["paths"] if "paths" in r.asDict() else None) for r in table.toLocalIterator()})

    def some(self, names: set[str]) -> dict[str, Site]:
        """A few sites, on the driver."""
        rows = self.table.where(F.col("site").isin(list(names))).collect() if names else []
        return {n: Site(n, None, None) for n in names} | {r["site"]: Site(r["site"], r["words"], r["paths"]) for r in rows}

    def scan(self, rows: DataFrame, function, schema: str, *columns: str) -> DataFrame:
        """``function(sites, batch columns)`` over (site, text, *columns); ``sites[name]`` gives the Site of a row."""
        if self.small is not None:
            small = self.small

            def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                book = {s: Site(s, *v) for s, v in small.value.items()}
                # A site the book does not know (texts that came later) has no winning path.
                site = lambda s: book.get(s) or book.setdefault(s, Site(s, None, None))
                yield from function((([site(s) for s in b.column(0).to_pylist()], *(b.column(i).to_pylist() for i in range(1, b.num_columns))) for b in batches))

            return rows.select("site", "text", *columns).mapInArrow(plain, schema)

        salted = rows.select("site", "text", *columns, F.pmod(F.xxhash64("text", F.spark_partition_id()), F.lit(SALTS)).cast("int").alias("_salt"), F.lit(1).alias("_order"), F.lit(None).cast("array<string>").alias("words"), F.lit(None).cast("array<string>").alias("paths"))
        own = self.table if "paths" in self.table.columns else self.table.withColumn("paths", F.lit(None).cast("array<string>"))
        own = own.select("site", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(0).alias("_order"), "words", "paths")
        width = 2 + len(columns)

        def sorted_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                name, site = None, None
                for b in batches:
                    cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
                    keep, sites = [], []
                    for i, order in enumerate(cols[width + 1]):
                        if order == 0:
                            name, site = cols[0][i], Site(cols[0][i], cols[width + 2][i], cols[width + 3][i])
                        else:
                            keep.append(i)
                            sites.append(site if cols[0][i] == name else Site(cols[0][i], None, None))
                    yield (sites, *([c[i] for i in keep] for c in cols[1:width]))

            yield from function(each())

        joined = salted.unionByName(own, allowMissingColumns=True).repartition("site", "_salt").sortWithinPartitions("site", "_salt", "_order")
        return joined.mapInArrow(sorted_scan, schema)


def fitted(df: DataFrame) -> Book:
    """The book of every site: known words and winning paths, from the whole table."""
    rows = rows_of(df)
    words = written(_known_words(rows), "site-books")

    def vote(parts) -> Iterator[pa.RecordBatch]:
        sums: dict = defaultdict(lambda: [0, 0.0])
        names: dict[int, str] = {}
        for sites, texts, own in parts:
            for site, text, name in zip(sites, texts, own):
                best: dict[str, list] = {"": [1, 0.0]}
                for _, path, score in _containers(site, text):
                    held = best.get(path)
                    if held is None:
                        best[path] = [1, score]
                    else:
                        held[0] += 1
                        held[1] += score
                for path, (n, score) in best.items():
                    held = sums[name, path]
                    held[0] += 1
                    held[1] += score / n
            if len(sums) > HELD:
                yield _partial(sums)
                sums.clear()
        if sums:
            yield _partial(sums)
        names.clear()

    again = rows.withColumn("own", F.col("site"))
    votes = Book(words).scan(again, vote, _COUNTS, "own").groupBy("site", "key").agg(F.sum("records").alias("records"), F.sum("score").alias("score"))
    votes = written(votes, "site-votes")
    return Book(written(words.join(_winners(votes), "site", "left").select("site", "words", "paths"), "site-paths"))


def furniture(site: Site, text: str) -> list[int]:
    """Numbers of the lines of a text that lie on a winning path of its site."""
    out = []
    for i, line in enumerate(text.split("\n"), 1):
        if line and len(line) <= PATH_CHARS and not line.isspace() and site.wins(line):
            out.append(i)
    return out


def main_text(site: Site, text: str) -> str:
    drop = set(furniture(site, text))
    return "\n".join(line for n, line in enumerate(text.split("\n"), 1) if n not in drop) if drop else text


def page_furniture(df: DataFrame, book: Book | None = None) -> DataFrame:
    """(id, lines): the furniture lines of each record that has any, one row an id."""
    book = book or fitted(df)

    def scan(parts) -> Iterator[pa.RecordBatch]:
        for sites, texts, ids in parts:
            out = [(i, lines) for i, site, text in zip(ids, sites, texts) if (lines := furniture(site, text))]
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.list_(pa.int32()))], names=["id", "lines"])

    return book.scan(rows_of(df), scan, "id string, lines array<int>", "id").groupBy("id").agg(F.max("lines").alias("lines"))


def furniture_lines(df: DataFrame, book: Book | None = None) -> DataFrame:
    """(id, line_no) of every line that is not main content."""
    return page_furniture(df, book).select("id", F.explode("lines").alias("line_no"))


def main_texts(df: DataFrame, book: Book | None = None, *columns: str) -> DataFrame:
    """(id, text, *columns of type string): every text that is not null with only its main content left; texts are
    read once more, never shuffled.

    Rows come as delivered: an id delivered twice has two equal rows, which a later step that shuffles anyway drops.
    """
    book = book or fitted(df)

    def scan(parts) -> Iterator[pa.RecordBatch]:
        for sites, texts, *rest in parts:
            out = [main_text(site, text) for site, text in zip(sites, texts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (rest[0], out, *rest[1:])], names=["id", "text", *columns])

    return book.scan(rows_of(df, *columns), scan, ", ".join(f"{c} string" for c in ("id", "text", *columns)), "id", *columns)

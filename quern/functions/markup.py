"""Text, titles and links of HTML pages (Arrow-batched parser), entries of Atom feeds, pages of wiki answers."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import strip

PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("links", T.ArrayType(T.StringType()))])
_SILENT = {"script", "style", "noscript", "template"}
_BLOCKS = {"div", "ul", "ol", "li", "table", "tr", "td", "section", "article", "nav", "footer", "body", "h1", "h2", "h3"}


class _Page(HTMLParser):
    """Paragraph texts, the first heading and all links. Unclosed paragraphs end where the next block begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.links: list[str] = []
        self.title: str | None = None
        self.paragraph = self.heading = False
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += 1
        elif tag == "p":
            self.paragraph = True
        elif tag in _BLOCKS:
            self.paragraph = False
        if tag == "h1":
            self.heading = self.title is None
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href" and v]

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "p" or tag in _BLOCKS:
            self.paragraph = False
        if tag == "h1":
            self.heading = False

    def handle_data(self, data):
        if self.silent:
            return
        if self.heading and self.title is None and data.strip():
            self.title = data.strip()
        if self.paragraph and data.strip():
            self.parts.append(data.strip())


def _parse(html: str | None, default: str) -> dict:
    if html is None:
        return {"title": None, "text": None, "links": None}
    page = _Page()
    page.feed(html)
    page.close()
    return {"title": page.title or default, "text": " ".join(page.parts), "links": list(dict.fromkeys(page.links))}


def page(html: str | Column, default_title: str = "untitled") -> Column:
    """(title, text, links) of an HTML page; all null for null."""

    @F.pandas_udf(PAGE)
    def parse(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_parse(h, default_title) for h in column], columns=PAGE.names)

    return parse(html)


def links(pages: Column | str, base: str | Column, containing: str = "", not_containing: str | None = None) -> Column:
    """Distinct links of :func:`page` that contain a text and not another, relative ones behind their base's host."""
    found = (F.col(pages) if isinstance(pages, str) else pages)["links"]
    base = F.col(base) if isinstance(base, str) else base
    kept = F.filter(found, lambda x: F.contains(x, F.lit(containing)) & (~F.contains(x, F.lit(not_containing)) if not_containing else F.lit(True)))
    host = F.regexp_extract(base, r"^([a-z]+://[^/?#]+)", 1)
    return F.array_distinct(F.transform(kept, lambda x: F.when(F.startswith(x, F.lit("/")), F.concat(host, x)).otherwise(x)))


def atom_entries(df: DataFrame, xml: str) -> DataFrame:
    """One row (…, title, link) per entry of a feed without namespaces that has a PDF link."""
    titles = F.xpath(xml, F.lit("/feed/entry[link[@type='application/pdf']]/title/text()"))
    hrefs = F.xpath(xml, F.lit("/feed/entry/link[@type='application/pdf']/@href"))
    rest = [c for c in df.columns if c != xml]
    return df.select(*rest, F.inline(F.arrays_zip(titles.alias("title"), hrefs.alias("link"))))


def wiki_pages(df: DataFrame, answer: str, longer_than: int = 200) -> DataFrame:
    """One row (…, page, title, extract) per page of a wiki answer with a title and an extract longer than the bound."""
    schema = "struct<query: struct<pages: map<string, struct<title: string, extract: string>>>>"
    rest = [c for c in df.columns if c != answer]
    rows = df.select(*rest, F.explode(F.from_json(answer, schema)["query"]["pages"]).alias("page", "_v"))
    rows = rows.select(*rest, "page", F.col("_v.title").alias("title"), strip(F.col("_v.extract")).alias("extract"))
    return rows.where((F.col("title") != "") & (F.length("extract") > longer_than))

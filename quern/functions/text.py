"""Text expressions that stay in the JVM. White space is Unicode white space as ``str.split`` sees it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as a regular-expression class body.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

#: Function words by language, for the default language guess.
COMMON_WORDS = {
    "pt": "o os as do da dos das não em um uma com no na já foi ao são pelo pela mais como",
    "en": "the of and that to is was for with not on at by it be this are from or which",
    "es": "el los las del en un una con y fue al se lo pero más como su es por sin",
    "fr": "le les des du que ne pas un une pour avec et au dans est sur par ce qui plus",
    "de": "der die das den dem des und nicht ist von mit im zu ein eine auf für als sich auch",
    "it": "il gli i dei della delle di che non un una per con è al nella sul più sono come",
}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def without_nul(c: str | Column) -> Column:
    """The value as a string without U+0000; null stays null."""
    return F.replace(_col(c).cast("string"), F.lit("\x00"), F.lit(""))


def char_count(c: str | Column) -> Column:
    """Code points, counted before U+0000 is removed."""
    return F.length(_col(c)).cast("long")


def word_count(c: str | Column) -> Column:
    """Runs of characters without white space; 0 for empty, null for null.

    Cutting at white space and taking off the empty ends is several times faster than counting matches.
    """
    c = _col(c)
    ends = F.when(c.rlike(f"^[{WHITE}]"), 1).otherwise(0) + F.when(c.rlike(f"[{WHITE}]\\z"), 1).otherwise(0)
    return F.when(c.isNull(), None).when(is_blank(c), F.lit(0)).otherwise(F.size(F.split(c, f"[{WHITE}]+")) - ends).cast("long")


def strip(c: str | Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_col(c), f"^[{WHITE}]+|[{WHITE}]+$", "")


def is_blank(c: str | Column) -> Column:
    """Null, empty or white space only."""
    c = _col(c)
    return c.isNull() | ~c.rlike(f"[^{WHITE}]")


def head(c: str | Column, size: int) -> Column:
    """The first ``size`` characters."""
    return F.substring(_col(c), 1, size)


def embedder_input(c: str | Column, size: int = 24_000) -> Column:
    """What is sent to be embedded: the first ``size`` characters, ``empty`` for blank texts."""
    return F.when(is_blank(c), F.lit("empty")).otherwise(head(c, size))


def recompose(cleaned: str | Column, raw: str | Column, size: int = 4_000) -> Column:
    """The cleaned head followed by what the cleaner was not shown."""
    return F.when(F.length(_col(raw)) > size, F.concat(_col(cleaned), F.substring(_col(raw), size + 1, 2_147_483_647))).otherwise(_col(cleaned))


def strip_markers(c: str | Column, start: str, end: str) -> Column:
    """Without a start marker at the very beginning and without all from the end marker on; stripped.

    The markers are regular expressions; case is ignored and a dot matches line breaks.
    """
    return strip(F.regexp_replace(F.regexp_replace(_col(c), f"(?is)\\A(?:{start})", ""), f"(?is)(?:{end}).*\\z", ""))


def first_contained(c: str | Column, names: list[str], default: str = "unknown") -> Column:
    """The first of ``names``, in their order, that the value contains."""
    return F.coalesce(*[F.when(F.contains(_col(c), F.lit(n)), F.lit(n)) for n in names], F.lit(default))


def base_name(c: str | Column) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)


def paired_name(c: str | Column, old: str = ".parquet", new: str = ".jsonl") -> Column:
    """The base name with every ``old`` replaced by ``new``."""
    return F.replace(base_name(c), F.lit(old), F.lit(new))


def url_or_generated(url: str | Column, key: str | Column) -> Column:
    """The url, or one made from a natural key where it is null or empty (the same for the same key)."""
    return F.when(_col(url).isNull() | (_col(url) == ""), F.concat(F.lit("generated_url_"), F.md5(_col(key).cast("string")))).otherwise(_col(url))


def source_of(url: str | Column, title: str | Column) -> Column:
    """The url, else the title, else ``unknown``; empty counts as missing."""
    return F.coalesce(F.nullif(_col(url), F.lit("")), F.nullif(_col(title), F.lit("")), F.lit("unknown"))


def render(template: str, **values: str | Column) -> Column:
    """``template`` with each {name} replaced by a column; null stands as empty."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(_col(value).cast("string"), F.lit("")))
    return out


def language(c: str | Column, least: int = 10) -> Column:
    """The language with most different function words in the text; ``unknown`` for short texts and texts without any.

    Of several equal ones the first in order of :data:`COMMON_WORDS`.
    """
    words = F.array_distinct(F.split(F.lower(_col(c)), r"[^\p{L}]+"))
    scores = [F.size(F.array_intersect(words, F.array(*map(F.lit, w.split())))).alias(code) for code, w in COMMON_WORDS.items()]
    best = F.greatest(*scores)
    pick = F.coalesce(*[F.when(s == best, F.lit(code)) for code, s in zip(COMMON_WORDS, scores)])
    return F.when(_col(c).isNull() | (F.length(strip(c)) < least) | (best == 0), F.lit("unknown")).otherwise(pick)

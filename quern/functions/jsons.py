"""JSON in strings: model answers in fences, metadata objects, nested results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import strip

CLEANED = T.StructType([T.StructField(n, T.StringType()) for n in ("cleaned_text", "topic", "difficulty", "domain")] + [T.StructField("language_quality", T.IntegerType())])


def unfenced(c: str | Column) -> Column:
    """The JSON text of a model's answer: as it is, or from between fences; null where neither is valid JSON."""
    c = F.col(c) if isinstance(c, str) else c
    plain = strip(c)
    tagged, bare = (strip(F.regexp_extract(c, f"(?s)```{tag}(.*?)(?:```|\\z)", 1)) for tag in ("json", ""))
    inner = F.when(F.contains(c, F.lit("```json")), tagged).when(F.contains(c, F.lit("```")), bare)
    valid = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(valid(plain), valid(inner))


def structured(c: str | Column, schema: T.StructType) -> Column:
    """A model's answer as a struct; null where it is no JSON object."""
    text = unfenced(c)
    return F.when(F.startswith(text, F.lit("{")), F.from_json(text, schema))


def metadata(**fields: str | Column) -> Column:
    """A JSON object of the fields; nulls are written."""
    return F.to_json(F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def field(c: str | Column, name: str) -> Column:
    """A field of a metadata string; null where the string is no JSON object."""
    return F.get_json_object(c, f"$.{name}")


def labelled_text(**parts: Column) -> Column:
    """``Title: a | Topic: b`` of the parts that are neither null nor empty; null where none is."""
    text = F.concat_ws(" | ", *[F.concat(F.lit(f"{name}: "), F.nullif(part, F.lit(""))) for name, part in parts.items()])
    return F.nullif(text, F.lit(""))

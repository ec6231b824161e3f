"""Schemas of the tables and the tolerant conforming of inputs to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "array<double>": T.ArrayType(T.DoubleType()),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(ddl: str) -> T.StructType:
    """A schema from ``name type [not null], ...``; needs no session, unlike ``fromDDL``."""
    fields = [part.strip().split(" ", 2) for part in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], not rest) for name, kind, *rest in fields])


RAW_CORPUS = _schema("id string, title string, text string, url string, language string, spider_name string, extracted_at timestamp, char_count bigint, word_count bigint, processed_clean boolean, processed_qa boolean")
CORPUS = _schema("id string, title string, text string, url string, language string, extracted_at timestamp, embedding array<double>, metadata string")
QA = _schema("id string, question string, reasoning string, answer string, model string, source string, embedding array<double>, metadata string")
CHUNKS = _schema("id string, record_id string, table_name string, chunk_index int, chunk_text string, embedding array<double>, created_at timestamp")
QUARANTINE = _schema(
    "id string, question string, reasoning string, answer string, model string, source string, embedding array<double>, metadata string,"
    " audit_flags array<string>, audit_scores string, audit_triggers array<string>, resposta_desejada string not null, audited_at timestamp"
)
CONVERSATIONS = _schema("id string, conversation_text string, metadata string, embedding array<double>")
MODELS = _schema("provider string, model_id string, last_seen timestamp")
IMPORTED = _schema("file_name string, file_type string")
RAW_FILE = _schema("title string, text string, url string, language string, extracted_at timestamp, char_count bigint, word_count bigint")
QA_LINE = _schema("question string, reasoning string, answer string, model string, source string")
EMBED_TASK = _schema("id string, database string, table string, source_column string, target_column string")
QA_TASK = _schema("id string, raw_id string")
CLEAN_TASK = _schema("id string")
#: Tables by name, with the columns their folders are partitioned by.
TABLES = {
    "raw_corpus": (RAW_CORPUS, []),
    "corpus": (CORPUS, []),
    "qa_dataset": (QA, []),
    "embeddings_chunks": (CHUNKS, ["table_name"]),
    "qa_dataset_quarantine": (QUARANTINE, []),
    "conversations_dataset": (CONVERSATIONS, []),
    "available_models": (MODELS, []),
    "imported_files": (IMPORTED, []),
}


class MissingColumn(ValueError):
    """A column without which an input is of no use is absent."""


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``schema`` in its order and types. A column that is absent takes its default (a null in a column
    that is there stays null); an absent required column raises :class:`MissingColumn`; other columns are dropped."""
    defaults = defaults or {}
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise MissingColumn(", ".join(absent))
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))).try_cast(f.dataType).alias(f.name) for f in schema])

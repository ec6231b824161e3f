"""Files: listings, tolerant Parquet, JSON lines, PDF pages, tables in folders and their staged publication."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import char_count, word_count
from quern.sources import schemas


def listed(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, size, modified) of the files under ``folder`` that end in ``suffix``; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def raw_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw Parquet files with their path in ``file`` and the row's place in it in ``position``: missing columns get their
    defaults, missing counts are taken from the text; without ``text`` this raises. Columns: :data:`schemas.RAW_FILE`."""
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    counts = {"char_count": char_count("text"), "word_count": word_count("text")}
    own = df.withColumns({n: c for n, c in counts.items() if n not in df.columns and "text" in df.columns})
    place = [T.StructField("file", T.StringType()), T.StructField("position", T.LongType())]
    own = own.withColumns({"file": F.col("_metadata.file_path"), "position": F.col("_metadata.row_index")})
    return schemas.conform(own, T.StructType([*schemas.RAW_FILE, *place]), {"title": "", "url": "", "language": "pt"}, ("text",))


def json_lines(spark: SparkSession, schema: T.StructType, *paths: str, defaults: dict[str, str] | None = None) -> DataFrame:
    """JSON-lines files with their path in ``file``. Blank lines are skipped; a bad line fails the read. A key that is
    absent takes its default, a null stays null."""
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    lines = lines.withColumn("_row", F.from_json("value", schema, {"mode": "FAILFAST"}))
    keys = F.json_object_keys("value")
    cols: list[Column] = []
    for f in schema:
        own = F.col("_row")[f.name]
        if defaults and f.name in defaults:
            own = F.when(~F.array_contains(keys, f.name), F.lit(defaults[f.name])).otherwise(own)
        cols.append(own.alias(f.name))
    return lines.select(*cols, "file")


def write_json_lines(df: DataFrame, path: str, *columns: str) -> None:
    """One JSON object a line, non-ASCII characters as they are, nulls written."""
    df.select(*columns or df.columns).write.option("ignoreNullFields", "false").mode("append").json(path)


def pdf_texts(spark: SparkSession, folder: str, read=None) -> DataFrame:
    """(path, text) of PDF files: the pages' texts joined by line breaks, stripped. ``read(bytes) -> list of page
    texts`` comes from a PDF library; without one this raises."""
    if read is None:
        raise RuntimeError("no PDF reader is configured")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder).select("path", "content")

    @F.pandas_udf("string")
    def text(contents):
        return contents.map(lambda b: "\n".join(read(bytes(b))).strip())

    return files.select("path", text("content").alias("text"))


class Store:
    """Tables as versioned Parquet folders under one root. A change of several tables is written to a staging folder
    and becomes visible at once when the pointer is replaced (a rename); readers see the old or the new state."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self) -> dict[str, str]:
        at = self._path(f"{self.root}/current")
        if not self._fs.exists(at):
            return {}
        return {r["name"]: r["folder"] for r in self.spark.read.schema("name string, folder string").json(f"{self.root}/current").collect()}

    def exists(self, name: str) -> bool:
        return name in self._pointer()

    def ensure(self, name: str) -> None:
        """Create a table with its schema where it does not exist."""
        if not self.exists(name):
            self.publish({name: self.spark.createDataFrame([], schemas.TABLES[name][0])})

    def read(self, name: str) -> DataFrame:
        schema, _ = schemas.TABLES[name]
        folder = self._pointer().get(name)
        if folder is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}").select(*schema.names)

    def publish(self, changed: dict[str, DataFrame]) -> None:
        """Replace whole tables, all or none."""
        run = uuid.uuid4().hex
        pointer = self._pointer()
        for name, df in changed.items():
            schema, by = schemas.TABLES[name]
            out = schemas.conform(df, schema)
            out.write.partitionBy(*by).parquet(f"{self.root}/{run}/{name}")
            pointer[name] = f"{run}/{name}"
        staged = self._path(f"{self.root}/{run}/pointer")
        self.spark.createDataFrame(list(pointer.items()), "name string, folder string").coalesce(1).write.json(staged.toString())
        old, current = self._path(f"{self.root}/{run}/old-pointer"), self._path(f"{self.root}/current")
        if self._fs.exists(current):
            self._fs.rename(current, old)
        if not self._fs.rename(staged, current):
            raise OSError(f"could not publish {run}")

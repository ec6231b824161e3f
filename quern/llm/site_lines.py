"""Lines repeated across one source's documents, kept as incremental per-source line counts.

A :class:`LineCounts` store holds three tables in shared storage: ``counts`` (source and line key -> number
of distinct records), ``seen`` (ids already merged) and ``postings`` (record, line number, line key). A new
partition is merged as a delta: records seen before are dropped, the delta's own counts are added to the old
ones, lines whose count crosses the threshold are detected, and only the documents that hold a newly crossed
line (old ones through the postings, new ones through the delta) get marks. Every mark is written once.

Two lines are the same if they differ only in letter case, in white space or in runs of decimal digits.
A line key is 96 bits of hash over source and normal form; distinct records are counted by a 64-bit hash.
A hot source needs no salting: counting is keyed by source *and* line. To count distinct records, one row for each
line of a record is shuffled, spread by line and record; what then arrives for a line, even one that every record of a
hot source has, is one partial count a task.

A store lives in its folder: opened again it goes on from the last merge. :meth:`LineCounts.rebuilt` gives new texts only
for the documents that the last merge marked; all others stay as they are.

Defined cases: null and empty texts have no lines; records with a null source form one source; an id that
is delivered again in a later partition counts once and keeps its first delivery (inside one partition its copies are taken
to be equal); a line that occurs twice in one record counts
once but is marked at both places; null ids are ignored; an empty table gives empty tables; extra columns
are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.runtime import broadcast_if_small, dropped, shared_dir

MIN_RECORDS = 12
MIN_LETTERS = 12
KEY = ["k1", "k2"]


def normal_line(line: Column) -> Column:
    """Lower case, white space runs as one space (none at the ends), digit runs as 0."""
    spaced = F.trim(F.regexp_replace(F.lower(line), r"(?U)[\s\x1c-\x1f]+", " "))
    return F.regexp_replace(spaced, r"\p{Nd}+", "0")


def keyed_lines(df: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(id, line_no, k1, k2) of each line with enough letters."""
    lines = df.where("id is not null and text is not null").select(
        "id", "spider_name", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    long_enough = (F.length("line") >= min_letters) & (F.length(F.regexp_replace("line", r"\P{L}+", "")) >= min_letters)
    normal = lines.where(long_enough).withColumn("line", normal_line(F.col("line")))
    return normal.select(
        "id",
        (F.col("pos") + 1).cast("int").alias("line_no"),
        F.xxhash64("spider_name", "line").alias("k1"),
        F.hash("line", "spider_name").alias("k2"),
    )


class LineCounts:
    """Incremental line counts of all sources under one folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str | None = None, min_records: int = MIN_RECORDS, min_letters: int = MIN_LETTERS):
        self.spark, self.min_records, self.min_letters = spark, min_records, min_letters
        self.path = path or f"{shared_dir(spark)}/line-counts-{uuid.uuid4().hex}"
        self.version = self._last()

    def _last(self) -> int:
        """The last merge that is whole: its marks, written at the end, are there."""
        spark, v = self.spark, 0
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        while files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._at('marks', v + 1)}/_SUCCESS")):
            v += 1
        return v

    def _at(self, name: str, version: int) -> str:
        return f"{self.path}/{name}/v={version:06d}"

    def _put(self, df: DataFrame, name: str, version: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._at(name, version))  # what a broken merge left is replaced
        return self.spark.read.schema(df.schema).parquet(self._at(name, version))

    def _all(self, name: str, upto: int) -> DataFrame:
        return self.spark.read.parquet(*[self._at(name, v) for v in range(1, upto + 1)])

    def merge(self, delta: DataFrame) -> DataFrame:
        """Add a partition of (id, text, spider_name); the (id, line_no) marks that this makes."""
        v = self.version + 1
        new = delta.select("id", "text", "spider_name")
        if self.version:
            new = new.join(self._all("seen", self.version), "id", "left_anti")
        postings = self._put(keyed_lines(new, self.min_letters), "postings", v)
        self._put(new.select("id").where("id is not null").distinct(), "seen", v)
        added = postings.groupBy(*KEY).agg(F.count_distinct(F.xxhash64("id")).alias("n"))
        if self.version:
            old = self.spark.read.parquet(self._at("counts", self.version))
            both = old.select(*KEY, F.col("n").alias("was"), F.lit(0).cast("long").alias("plus")).unionByName(
                added.select(*KEY, F.lit(0).cast("long").alias("was"), F.col("n").alias("plus"))
            )
            counts = both.groupBy(*KEY).agg(F.sum("was").alias("was"), F.sum("plus").alias("plus")).select(
                *KEY, (F.col("was") + F.col("plus")).alias("n"), "was"
            )
        else:
            counts = added.withColumn("was", F.lit(0).cast("long"))
        counts = self._put(counts, "counts", v)
        over = counts.where(F.col("n") >= self.min_records)
        marks = postings.join(broadcast_if_small(over.select(*KEY)), KEY, "left_semi")
        if self.version:
            crossed = broadcast_if_small(over.where(F.col("was") < self.min_records).select(*KEY))
            marks = marks.unionByName(self._all("postings", self.version).join(crossed, KEY, "left_semi"))
        self.version = v
        return self._put(marks.select("id", "line_no").distinct(), "marks", v)

    def marks(self) -> DataFrame:
        """(id, line_no) of every repeated line so far."""
        return self._all("marks", self.version)

    def rebuilt(self, texts: DataFrame) -> DataFrame:
        """(id, text) of the documents that hold a line newly marked by the last merge, without any marked line;
        ``texts``: (id, text) of all documents so far. Other documents are neither joined with marks nor written."""
        newly = broadcast_if_small(self.spark.read.parquet(self._at("marks", self.version)).select("id").distinct())
        return without_lines(texts.join(newly, "id", "left_semi"), self.marks().join(newly, "id", "left_semi"))

    def drop(self, *names: str) -> None:
        """Delete tables of a store that takes no further merge."""
        dropped(self.spark, *[f"{self.path}/{n}" for n in names])


def repeated_lines(df: DataFrame, min_records: int = MIN_RECORDS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(id, line_no) of every repeated line of a whole table, merged as the store's first partition."""
    store = LineCounts(df.sparkSession, None, min_records, min_letters)
    marks = store.merge(df)
    store.drop("counts", "seen", "postings")
    return marks


def merged_lines(partitions: list[DataFrame], min_records: int = MIN_RECORDS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(id, line_no) of every repeated line of partitions merged one after the other as deltas."""
    store = LineCounts(partitions[0].sparkSession, None, min_records, min_letters)
    for part in partitions:
        store.merge(part)
    store.drop("counts", "seen", "postings")
    return store.marks()


def without_lines(df: DataFrame, marks: DataFrame) -> DataFrame:
    """(id, text): each record's text without its marked lines; one row per id."""
    drop = marks.groupBy("id").agg(F.collect_set("line_no").alias("_drop"))
    rows = df.select("id", "text").dropDuplicates(["id"]).join(drop, "id", "left")
    kept = F.expr("array_join(filter(split(text, '\\n'), (x, i) -> not array_contains(_drop, i + 1)), '\\n')")
    return rows.select("id", F.when(F.col("_drop").isNull() | F.col("text").isNull(), F.col("text")).otherwise(kept).alias("text"))

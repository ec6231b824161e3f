"""Session helpers shared by every operator: table access, shared storage, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it stays under both bounds.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Folders written by this driver, for :func:`scratch`.
_WRITTEN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` (a file or a directory of parts) under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests, a laptop) a temporary folder is set; a cluster
    must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors reach")
    own = tempfile.mkdtemp(prefix="quern-")
    spark.conf.set("spark.checkpoint.dir", own)
    spark.sparkContext.setCheckpointDir(own)
    return own


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete folders of the shared storage that no later step reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` to the shared folder, in folders by the columns ``by``, and read it back: cuts lineage and survives
    lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`written` put into the shared folder inside the block. Results must be stored before it ends."""
    start = len(_WRITTEN)
    try:
        yield
    finally:
        paths = _WRITTEN[start:]
        del _WRITTEN[start:]
        dropped(spark, *paths)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``rows`` rows and their text form at most ``size`` bytes;
    otherwise as it is (a shuffled join).

    Counting stops one row over the bound, so the check itself stays cheap on a large side. ``df`` should be something
    cheap to evaluate twice, such as the result of :func:`written`.
    """
    few = df.limit(rows + 1)
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    count, total = few.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if count <= rows and total <= size else df

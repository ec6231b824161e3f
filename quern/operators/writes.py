"""Changes of tables as DataFrames: inserts that skip known keys, upserts, replacements, updates, moves.

Each returns the new state or the rows to append; :class:`quern.sources.files.Store` publishes it. Keys meet by
equi-joins, so a hot key is split by adaptive execution. A null key never matches and is never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def first_of(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """One row for each key, the first by ``order``; rows with a null key all stay."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    return _best(df.where(known), keys, order).unionByName(df.where(~known))


def insert_ignore(target: DataFrame, rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The rows an insert that ignores known keys adds: the first of each key, unless the target has the key."""
    return first_of(rows, [key], *order).join(target.select(key), key, "left_anti").select(*rows.columns)


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """The target after rows with known keys replaced the old ones; of several the newest wins, a null is oldest."""
    both = target.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    return _best(both, keys, [F.desc("_new"), F.desc_nulls_last(newest)]).drop("_new").select(*target.columns)


def replace_records(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The target without any row of the records in ``rows``, and with ``rows``."""
    return target.join(rows.select(*keys).distinct(), keys, "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def update(target: DataFrame, values: DataFrame, key: str, *columns: str) -> DataFrame:
    """The target with the columns set from ``values`` (unique keys) where the key is there and the value is not null."""
    new = values.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = target.join(new, key, "left")
    return out.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}).select(*target.columns)


def set_flag(target: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """The target with ``flag`` true for the ids."""
    done = ids.select(key).distinct().withColumn("_done", F.lit(True))
    return target.join(done, key, "left").withColumn(flag, F.col("_done").isNotNull() | F.col(flag)).select(*target.columns)


def delete(target: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None, only: Column | None = None) -> DataFrame:
    """The target without the rows of the ids, where ``only`` is true if it is given."""
    gone = ids.select(F.col(ids_key or key).alias(key)).distinct().withColumn("_gone", F.lit(True))
    hit = F.col("_gone").isNotNull() & (F.coalesce(only, F.lit(False)) if only is not None else F.lit(True))
    return target.join(gone, key, "left").where(~hit).select(*target.columns)

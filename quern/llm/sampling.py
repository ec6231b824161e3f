"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def bounded_texts(df: DataFrame, id_col: str, text_col: str, *columns: str | Column, rows: int, chars: int, longest: int) -> list[Row]:
    """(id, text, *columns) of at most ``rows`` rows and ``chars`` characters, about evenly over the table: those
    with the smallest hash of their id. Texts that are null, empty or longer than ``longest`` are no part of it.

    A hash threshold from the table's row count leaves little more than the wanted rows; of these the driver first
    gets hashes and lengths and then only the texts within both bounds, whatever the size of the table.
    """
    total = df.count()
    if not total:
        return []
    share = min(1.0, 1.3 * rows / total + 20 / total)
    key = F.xxhash64(id_col)
    some = df.where(F.length(text_col).between(1, longest))
    if share < 1:
        some = some.where(F.pmod(key, F.lit(1 << 30)) < int(share * (1 << 30)))
    last, held, count, before = None, 0, 0, None
    for h, size in sorted(map(tuple, some.select(key, F.length(text_col)).collect())):
        if h == before:  # delivered twice
            continue
        before, held, count = h, held + size, count + 1
        if held > chars or count > rows:
            break
        last = h
    if last is None:
        return []
    picked = some.where(key <= last).select(key.alias("_h"), F.col(id_col), F.col(text_col), *columns).collect()
    return list({r[0]: r for r in sorted(picked, key=lambda r: r[0])}.values())

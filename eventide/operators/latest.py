"""Latest row per key.

``latest_ties`` keeps every row at its key's newest value, ``latest_per_key`` exactly
one row per key.  Both reduce map-side first, so a hot key does not meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_ties(df: DataFrame, key: str, by: str) -> DataFrame:
    """Rows whose ``by`` equals their key's maximum (all ties kept; NULL keys
    and NULL ``by`` never match).

    The newest value of each key is a grouped maximum; a semi-join on (key, value)
    keeps the rows that have it.  The join hashes both columns, so a key with very
    many rows is spread over its values."""
    newest = df.groupBy(key).agg(F.max(by).alias(by))
    return df.join(newest, [key, by], "left_semi")


def latest_per_key(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """One row per key: the row with the largest ``order`` tuple (later columns
    break ties).  ``order`` values must not be NULL for the winning row."""
    cols = df.columns
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    best = df.groupBy(F.col(key).alias("_lk")).agg(F.max_by(F.struct(*cols), rank).alias("_row"))
    return best.select("_row.*")

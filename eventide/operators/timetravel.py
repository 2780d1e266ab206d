"""Time travel over a key history: the state of every key as of ``T`` and the
changes after ``T``.

Two forms of each query:

* **array form** over the history table (each row holds a key's history, or one
  segment of it, as four parallel arrays).  The arrays are zipped into one array of
  changes; the snapshot is the last change dated ``<= T``, the replay is every change
  dated ``> T``.  One row at a time, no shuffle until the final sort;
* **row form** over the flat change log: ``max_by`` (partial aggregation) for
  the snapshot, a pushed-down range filter plus a range-partitioned sort for the
  replay.  Store the log sorted by date and Parquet min/max statistics skip the
  files outside the range.

Accepted changes have non-decreasing dates, so both forms give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DATE_EVENT, EVENT_TYPE, ID, LAT, LNG, LOCATION, SEQ, SNAPSHOT_COLUMNS

def _t(at: int | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(int(at)).cast("long")


def select_ids(df: DataFrame, ids) -> DataFrame:
    """Keep the rows of the given keys: a literal list becomes ``IN`` (pushed to
    Parquet); a DataFrame of keys (first column) becomes a ``left_semi`` join, which
    Catalyst broadcasts only when its size statistics allow it."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).cast("string").alias(ID)).distinct()
        return df.join(keys, ID, "left_semi")
    return df.where(F.col(ID).isin(list(ids)))


def history_changes() -> Column:
    """A history row's changes as one array of structs, in arrival order."""
    return F.arrays_zip(
        F.col("date_event_memory").alias("date"),
        F.col("event_type_memory").alias("type"),
        F.col("coordinates_memory").alias("place"),
        F.col("location_memory").alias("location"),
    )


def _snapshot_of(change: Column) -> list[Column]:
    """The snapshot columns of one change of :func:`history_changes`."""
    return [
        change["date"].alias(DATE_EVENT),
        change["type"].alias(EVENT_TYPE),
        change["location"].alias(LOCATION),
        F.get(change["place"], 0).alias(LAT),
        F.get(change["place"], 1).alias(LNG),
    ]


def asof_snapshot(table: DataFrame, at: int | Column) -> DataFrame:
    """Array form: per key, the last change dated ``<= at``; keys without one are
    absent."""
    t = _t(at)
    known = F.filter(history_changes(), lambda c: c["date"] <= t)
    segmented = "segment" in table.columns
    if segmented:
        # Segments that begin later are not read.
        table = table.where(F.col("first_date") <= t)
    rows = table.select(ID, *(["last_seq"] if segmented else []), F.try_element_at(known, F.lit(-1)).alias("_last"))
    rows = rows.where(F.col("_last").isNotNull())
    if segmented:
        # Of a key's segments the last one that has such a change answers (partial aggregation).
        rows = rows.groupBy(ID).agg(F.max_by("_last", "last_seq").alias("_last"))
    return rows.select(ID, *_snapshot_of(F.col("_last"))).select(*SNAPSHOT_COLUMNS)


def replay_after(table: DataFrame, at: int | Column, ids: Iterable[str] | DataFrame | None = None, sort: bool = True) -> DataFrame:
    """Array form: every change dated ``> at``, one row each, ascending by date."""
    t = _t(at)
    later = F.filter(history_changes(), lambda c: c["date"] > t)
    # A row's last date: histories, or segments, that end earlier are not read.
    table = table.where(F.col(DATE_EVENT) > t)
    rows = select_ids(table, ids).select(ID, F.explode(later).alias("_c")).select(ID, *_snapshot_of(F.col("_c")))
    rows = rows.select(*SNAPSHOT_COLUMNS)
    return rows.orderBy(DATE_EVENT, ID) if sort else rows


def asof_snapshot_rows(changes: DataFrame, at: int | Column, order: str = SEQ) -> DataFrame:
    """Row form of :func:`asof_snapshot` over the change log."""
    t = _t(at)
    best = (
        changes.where(F.col(DATE_EVENT) <= t)
        .groupBy(ID)
        .agg(F.max_by(F.struct(*SNAPSHOT_COLUMNS[1:]), F.struct(F.col(DATE_EVENT), F.col(order))).alias("_b"))
    )
    return best.select(ID, *[F.col("_b")[c].alias(c) for c in SNAPSHOT_COLUMNS[1:]])


def replay_after_rows(
    changes: DataFrame, at: int | Column, ids: Iterable[str] | DataFrame | None = None, order: str = SEQ, sort: bool = True
) -> DataFrame:
    """Row form of :func:`replay_after`; ties on date are ordered by key, then
    arrival, for a deterministic output."""
    t = _t(at)
    rows = select_ids(changes.where(F.col(DATE_EVENT) > t), ids)
    if sort:
        rows = rows.orderBy(DATE_EVENT, ID, order)
    return rows.select(*SNAPSHOT_COLUMNS)


def current_state(changes: DataFrame, order: str = SEQ) -> DataFrame:
    """Scalar columns of the latest change per key, from the change log or from
    history-table rows (``max_by`` on arrival position, partially aggregated)."""
    if "coordinates" in changes.columns:
        changes = changes.select(
            ID,
            DATE_EVENT,
            EVENT_TYPE,
            LOCATION,
            F.get("coordinates", 0).alias(LAT),
            F.get("coordinates", 1).alias(LNG),
            F.col("last_seq" if "last_seq" in changes.columns else order).alias(order),
        )
    best = changes.groupBy(ID).agg(F.max_by(F.struct(*SNAPSHOT_COLUMNS[1:]), F.col(order)).alias("_b"))
    return best.select(ID, *[F.col("_b")[c].alias(c) for c in SNAPSHOT_COLUMNS[1:]])

"""Key histories: the change log with each key's history so far as parallel
arrays, and the history table (the arrays of each key).

The per-change arrays are quadratic in a key's history length by definition
(every change repeats everything before it) and one task holds a key; they are
built only when asked for.  The stored form is the flat change log.  The history
table has one row per key, or, with a segment size, one row per so many changes of
a key, numbered over the whole key: then no row holds an unbounded key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATE_EVENT, EVENT_TYPE, HISTORY_ROW, ID, LAT, LNG, LOCATION, SEQ

MEMORY_COLUMNS = ["date_event_memory", "event_type_memory", "coordinates_memory", "location_memory"]
# Stored row of the latest-state table: the history row and its arrival position.
TABLE_ROW = T.StructType(list(HISTORY_ROW.fields) + [T.StructField("last_seq", T.LongType())])
# A row of the segmented history table: a run of a key's changes, from ``first_date`` to ``date_event``.
SEGMENT_ROW = T.StructType(
    [*TABLE_ROW.fields, T.StructField("segment", T.LongType()), T.StructField("first_date", T.LongType())]
)


def coordinates(lat: str = LAT, lng: str = LNG) -> Column:
    """The ``(lat, lng)`` pair as a two-element array."""
    return F.array(F.col(lat), F.col(lng))


def _change(order: str) -> Column:
    """A change as one struct: a field that is NULL stays in its place in the arrays."""
    return F.struct(
        F.col(order).alias("seq"),
        F.col(DATE_EVENT).alias("date"),
        F.col(EVENT_TYPE).alias("type"),
        coordinates().alias("place"),
        F.col(LOCATION).alias("location"),
    )


def _memory(history: str) -> list[Column]:
    fields = ["date", "type", "place", "location"]
    return [F.col(f"{history}.{f}").alias(c) for f, c in zip(fields, MEMORY_COLUMNS, strict=True)]


def history_rows(changes: DataFrame, key: str = ID, order: str = SEQ) -> DataFrame:
    """Every accepted change with the key's history up to and including it
    (one running ``collect_list`` of changes over the key, in arrival order)."""
    so_far = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = changes.withColumn("_so_far", F.collect_list(_change(order)).over(so_far))
    return rows.select(
        F.col(key).alias(ID),
        F.col(EVENT_TYPE),
        F.col(DATE_EVENT),
        coordinates().alias("coordinates"),
        F.col(LOCATION),
        *_memory("_so_far"),
        F.col(order).alias(SEQ),
    )


def numbered_changes(changes: DataFrame, key: str = ID, order: str = SEQ) -> DataFrame:
    """``changes`` with ``_number``: the position of a change in its key's history, from 0.

    Annotated changes bring it along (``change_no`` of ``annotate_transitions``): no further
    pass.  Others are numbered by a window over the key."""
    if "change_no" in changes.columns:
        return changes.withColumn("_number", F.col("change_no"))
    return changes.withColumn("_number", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)


def history_table(changes: DataFrame, key: str = ID, order: str = SEQ, segment_size: int | None = None) -> DataFrame:
    """One row per key with its current values and the four history arrays (in arrival order).

    With ``segment_size``: one row per key and segment; segment ``i`` holds the changes
    ``i * segment_size`` to ``(i + 1) * segment_size - 1`` of the key, whatever the
    layout of the input.  Its dates are between ``first_date`` and ``date_event``, so time travel
    skips segments (and, stored, files) by them."""
    keys = [F.col(key).alias(ID)]
    if segment_size:
        changes = numbered_changes(changes, key, order)
        keys.append(F.floor(F.col("_number") / F.lit(segment_size)).alias("segment"))
    grouped = changes.groupBy(*keys).agg(F.array_sort(F.collect_list(_change(order))).alias("_h"))
    last = F.element_at("_h", -1)
    return grouped.select(
        ID,
        last["type"].alias(EVENT_TYPE),
        last["date"].alias(DATE_EVENT),
        last["place"].alias("coordinates"),
        last["location"].alias(LOCATION),
        *_memory("_h"),
        last["seq"].alias("last_seq"),
        *(["segment", F.get("_h", F.lit(0))["date"].alias("first_date")] if segment_size else []),
    )


def history_text(rows: DataFrame, sep: str = "|") -> DataFrame:
    """History arrays joined to text (type and date arrays) plus their length."""
    return rows.select(
        ID,
        EVENT_TYPE,
        DATE_EVENT,
        F.array_join("event_type_memory", sep).alias("event_type_memory"),
        F.array_join(F.col("date_event_memory").cast("array<string>"), sep).alias("date_event_memory"),
        F.size("date_event_memory").cast("long").alias("n"),
    )


def locations_text(rows: DataFrame, sep: str = "|", null: str = "~") -> DataFrame:
    """Each history row's locations joined to text, NULL ones as ``null``."""
    return rows.select(
        ID,
        DATE_EVENT,
        F.array_join("location_memory", sep, null).alias("location_memory"),
        F.size("location_memory").cast("long").alias("n"),
        F.size("coordinates_memory").cast("long").alias("n_coordinates"),
    )

"""Record layouts and the input-field mapping.

Four fixed layouts: the flat change (one event), the history row (a change plus
the key's history so far as four parallel arrays), the time-travel output and
the stored change log.  Field names of the *input* JSON are configurable
through :class:`ColumnMapping`; everything downstream uses the canonical
lower-case names below.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import types as T

# Canonical column names.
ID = "id"
EVENT_TYPE = "event_type"
DATE_EVENT = "date_event"
LAT = "lat"
LNG = "lng"
LOCATION = "location"
# Arrival position of an event; the transition rule folds events in this order.
SEQ = "seq"

# Fixed values of the transition rule: the state every key starts from.
INITIAL_TYPE = "-"
INITIAL_DATE = 0


@dataclass(frozen=True)
class ColumnMapping:
    """Names of the six input JSON fields (defaults are the upper-case names)."""

    id: str = "ID"
    event_type: str = "EVENT_TYPE"
    date_event: str = "DATE_EVENT"
    lat: str = "LAT"
    lng: str = "LNG"
    location: str = "LOCATION"

    def __post_init__(self) -> None:
        empty = [f.name for f in fields(self) if not str(getattr(self, f.name) or "").strip()]
        if empty:
            raise ValueError(f"column mapping has empty names for: {', '.join(empty)}")

    def as_dict(self) -> dict[str, str]:
        """canonical name -> input field name"""
        return {f.name: getattr(self, f.name) for f in fields(self)}


FLAT_CHANGE = T.StructType(
    [
        T.StructField(ID, T.StringType()),
        T.StructField(EVENT_TYPE, T.StringType()),
        T.StructField(DATE_EVENT, T.LongType()),
        T.StructField(LAT, T.DoubleType()),
        T.StructField(LNG, T.DoubleType()),
        T.StructField(LOCATION, T.StringType()),
    ]
)

# History row as written to the second topic / stored in the history table.
HISTORY_ROW = T.StructType(
    [
        T.StructField(ID, T.StringType()),
        T.StructField(EVENT_TYPE, T.StringType()),
        T.StructField(DATE_EVENT, T.LongType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
        T.StructField(LOCATION, T.StringType()),
        T.StructField("date_event_memory", T.ArrayType(T.LongType())),
        T.StructField("event_type_memory", T.ArrayType(T.StringType())),
        T.StructField("coordinates_memory", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("location_memory", T.ArrayType(T.StringType())),
    ]
)

# Output of the as-of snapshot and of the replay.
SNAPSHOT_COLUMNS = [ID, DATE_EVENT, EVENT_TYPE, LOCATION, LAT, LNG]
FLAT_COLUMNS = [ID, EVENT_TYPE, DATE_EVENT, LAT, LNG, LOCATION]

# Stored change log: the flat change plus its arrival position.
CHANGE_LOG = T.StructType(list(FLAT_CHANGE.fields) + [T.StructField(SEQ, T.LongType())])

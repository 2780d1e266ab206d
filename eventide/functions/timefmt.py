"""Time and argument helpers of the batch reader.

``event_time_millis`` turns a ``dd/MM/yyyy`` date text and a ``HH:mm:ss`` time
text into epoch milliseconds, the wall clock read as UTC whatever the session
time zone; invalid dates give NULL (no lenient roll-over).  ``parse_ids`` reads the id-list argument.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the reader's date and time arguments, and the
# id-list argument that means "all ids".
DATE_FORMAT = "dd/MM/yyyy"
TIME_FORMAT = "HH:mm:ss"
TEXT_PATTERN = r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}):(\d{2}):(\d{2})$"
ALL_IDS = "no-id"


def wall_clock_millis(ts: Column) -> Column:
    """Epoch milliseconds (floor) of a TIMESTAMP_NTZ read as UTC wall-clock time.

    Built from the date and time-of-day fields, which carry no zone, so the
    result does not depend on ``spark.sql.session.timeZone``."""
    day_ms = F.unix_date(ts.cast("date")).cast("long") * F.lit(86_400_000)
    secs = F.date_part(F.lit("SECOND"), ts)  # seconds with microsecond fraction
    tod = F.hour(ts).cast("long") * 3_600_000 + F.minute(ts).cast("long") * 60_000 + F.floor(secs * 1000)
    return (day_ms + tod).cast("long")


def event_time_millis(date_text: Column | str, time_text: Column | str) -> Column:
    """Epoch ms of ``dd/MM/yyyy`` + ``HH:mm:ss`` texts, the wall clock read as UTC.

    The texts must match the layout exactly; impossible dates or times give NULL.
    The value is built without a session-zone timestamp, so no zone (and no DST
    gap) shifts it."""
    d = F.col(date_text) if isinstance(date_text, str) else date_text
    t = F.col(time_text) if isinstance(time_text, str) else time_text
    text = F.concat_ws(" ", d, t)
    part = [F.regexp_extract(text, TEXT_PATTERN, i).try_cast("int") for i in range(1, 7)]
    day, month, year, hour, minute, second = part
    ts = F.try_make_timestamp_ntz(year, month, day, hour, minute, second)
    return wall_clock_millis(ts)


def event_time_literal(spark, date_text: str, time_text: str) -> int | None:
    """Driver-side value of :func:`event_time_millis` for one argument pair."""
    row = spark.range(1).select(event_time_millis(F.lit(date_text), F.lit(time_text)).alias("t")).first()
    return row["t"]


def parse_ids(text: str | None) -> list[str] | None:
    """``"a,b,c"`` -> ``["a", "b", "c"]``; ``"no-id"`` or empty -> ``None`` (all ids)."""
    if text is None or text.strip() in ("", ALL_IDS):
        return None
    return [p.strip() for p in text.split(",") if p.strip()]


def split_ids(col: Column | str) -> Column:
    """Column form of :func:`parse_ids` (NULL for "all ids")."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.trim(c) == ALL_IDS, F.lit(None)).otherwise(parts)

"""Named queries over the driver's tables: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  All read the
``events`` (or ``orders``) table through the canonical mapping, so their work
grows with the data.  ``T`` is the fixed time-travel instant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonio, timefmt
from ..operators import history as hist
from ..operators import latest, timetravel, transitions
from ..schema import DATE_EVENT, EVENT_TYPE, FLAT_COLUMNS, ID, SEQ
from ..session import shared_path
from ..sources import events as src
from ..sources import parts

# Fixed query parameters: the time-travel instant (2024-01-15 00:00:00 UTC), the
# id list of the filtered replay and the reader's sample date/time texts.
T = 1705276800000
REPLAY_IDS = "3,7,11"
# Skew case: every HOT_EVERY-th event (by arrival) belongs to one key.
HOT_KEY = "hot"
HOT_EVERY = 3
# Changes in a row of the history table; a longer history goes on in the next segment.
SEGMENT_SIZE = 10_000

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str, arrival: str = "event_id") -> DataFrame:
    return src.events_from_table(spark, sf_dir, arrival)


def _changes(spark: SparkSession, sf_dir: str, arrival: str = "event_id") -> DataFrame:
    return transitions.transitions(_events(spark, sf_dir, arrival))


def _history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.history_table(_changes(spark, sf_dir), segment_size=SEGMENT_SIZE)


# --- first hop: parse, filter, history -------------------------------------------------


def q_parse_events(spark, sf_dir):
    messages = src.to_input_json(_events(spark, sf_dir))
    good, _ = src.split_valid(src.parse_events(messages, keep=[SEQ]))
    return good.select(*FLAT_COLUMNS, SEQ)


def q_transitions(spark, sf_dir):
    return _changes(spark, sf_dir).select(*FLAT_COLUMNS)


def q_transitions_hot_key(spark, sf_dir):
    """Every third event moved to one key: a third of all rows share a key, which
    the range layout spreads over several tasks (all rows kept)."""
    events = _events(spark, sf_dir).withColumn(
        ID, F.when(F.col(SEQ) % HOT_EVERY == 0, F.lit(HOT_KEY)).otherwise(F.col(ID))
    )
    return transitions.transitions(events).select(*FLAT_COLUMNS)


def q_transitions_out_of_order(spark, sf_dir):
    return _changes(spark, sf_dir, "shuffled").select(*FLAT_COLUMNS)


def q_late_rejected(spark, sf_dir):
    return transitions.late_rejected(_events(spark, sf_dir, "shuffled")).select(*FLAT_COLUMNS)


def q_change_kind(spark, sf_dir):
    kinds = transitions.with_change_kind(_changes(spark, sf_dir))
    return kinds.select(ID, EVENT_TYPE, DATE_EVENT, "change_kind", "previous_type")


def q_history_rows(spark, sf_dir):
    return hist.history_text(hist.history_rows(_changes(spark, sf_dir)))


def q_history_rows_nulls(spark, sf_dir):
    """Histories with a NULL location in every fourth change: the arrays stay parallel."""
    changes = _changes(spark, sf_dir)
    changes = changes.withColumn("location", F.when(F.col(SEQ) % 4 != 0, F.col("location")))
    return hist.locations_text(hist.history_rows(changes))


def q_parse_rejects(spark, sf_dir):
    """Every message is an event or a reject: one message in seven has no date, one in
    eleven no key, one in thirteen is no JSON at all."""
    messages = src.to_input_json(_events(spark, sf_dir))
    blank = F.regexp_replace("value", '"DATE_EVENT":[^,}]*', '"DATE_EVENT":null')
    blank = F.when(F.col(SEQ) % 7 == 0, blank).otherwise(F.col("value"))
    blank = F.when(F.col(SEQ) % 11 == 0, F.regexp_replace(blank, '"ID":"[^"]*"', '"ID":null')).otherwise(blank)
    blank = F.when(F.col(SEQ) % 13 == 0, F.lit("not json")).otherwise(blank)
    good, bad = src.split_valid(src.parse_events(messages.withColumn("value", blank), keep=[SEQ, "value"]))
    return good.select(SEQ, F.lit(True).alias("accepted")).union(bad.select(SEQ, F.lit(False)))


#: The date of message ``n`` as each JSON type, by ``n % 7``.
TYPED_DATES = ("{n}", '"{n}"', "{n}.9", '"x{n}"', "true", "null", '{{"a": {n}}}')


def q_parse_types(spark, sf_dir):
    """Dates and types of messages of every JSON type, coerced by that type; one message in
    eleven has no date and is not valid."""
    events = _events(spark, sf_dir)
    n = F.col(SEQ).cast("string")
    kind = F.col(SEQ) % len(TYPED_DATES)
    date = F.lit(None).cast("string")
    for i, form in enumerate(TYPED_DATES):
        head, _, tail = form.replace("{{", "{").replace("}}", "}").partition("{n}")
        date = F.when(kind == i, F.concat(F.lit(head), n, F.lit(tail)) if "{n}" in form else F.lit(head)).otherwise(date)
    value = F.concat(F.lit('{"ID":"'), ID, F.lit('","EVENT_TYPE":'), date, F.lit(',"LAT":'), date, F.lit(',"LNG":1,"LOCATION":[1]'))
    value = F.concat(value, F.when(F.col(SEQ) % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(',"DATE_EVENT":'), date)), F.lit("}"))
    parsed = src.parse_events(events.select(SEQ, value.alias("value")), coercion="typed", keep=[SEQ])
    return parsed.select(SEQ, EVENT_TYPE, F.coalesce(DATE_EVENT, F.lit(-1)).alias(DATE_EVENT), "lat", "location", "valid")


# --- second hop: latest per key, table, upsert -------------------------------------------


def q_latest_ties(spark, sf_dir):
    orders = src.read_table(spark, sf_dir, "orders")
    return latest.latest_ties(orders, "o_custkey", "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice")


def q_latest_per_key(spark, sf_dir):
    orders = src.read_table(spark, sf_dir, "orders")
    one = latest.latest_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"])
    return one.select("o_custkey", "o_orderkey", "o_totalprice")


def _two_batch_table(spark, sf_dir) -> str:
    """The history table as two batches wrote it (changes dated <= T, then the rest): each adds
    a part with the segments of its own changes."""
    path = shared_path(spark, "tables", "history", unique=True)
    parts.ensure(spark, path, hist.SEGMENT_ROW)
    changes = _changes(spark, sf_dir)
    for version, window in enumerate((F.col(DATE_EVENT) <= T, F.col(DATE_EVENT) > T), start=1):
        rows = hist.history_table(changes.where(window), segment_size=SEGMENT_SIZE)
        parts.write_part(rows.select(*hist.SEGMENT_ROW.names), path, version)
    return path


def q_upsert_merge(spark, sf_dir):
    path = _two_batch_table(spark, sf_dir)
    return timetravel.current_state(parts.read_parts(spark, path, hist.SEGMENT_ROW))


def q_table_at_version(spark, sf_dir):
    path = _two_batch_table(spark, sf_dir)
    return timetravel.current_state(parts.read_parts(spark, path, hist.SEGMENT_ROW, upto=1))


def q_ensure_table(spark, sf_dir):
    """Create-if-absent is idempotent: a second ensure keeps the data."""
    path = _two_batch_table(spark, sf_dir)
    parts.ensure(spark, path, hist.SEGMENT_ROW)
    return timetravel.current_state(parts.read_parts(spark, path, hist.SEGMENT_ROW)).select(ID, DATE_EVENT)


def q_asof_stored(spark, sf_dir):
    """The snapshot from the stored segments: those that begin after T are not read."""
    path = _two_batch_table(spark, sf_dir)
    return timetravel.asof_snapshot(parts.read_parts(spark, path, hist.SEGMENT_ROW), T)


def q_replay_stored(spark, sf_dir):
    """The replay from the stored segments: those that end by T are not read."""
    path = _two_batch_table(spark, sf_dir)
    return timetravel.replay_after(parts.read_parts(spark, path, hist.SEGMENT_ROW), T)


def q_merge_latest(spark, sf_dir):
    """A keyed table merged in three batches (arrival thirds of the orders), the middle one given
    twice, compacted after the second: the latest order per customer by date, then number."""
    path = shared_path(spark, "tables", "orders", unique=True)
    orders = src.read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    orders = orders.withColumn("rank", F.struct("o_orderdate", "o_orderkey"))
    parts.ensure(spark, path, orders.schema)
    for version, third in ((1, 0), (2, 1), (2, 1), (3, 2)):
        batch = latest.latest_per_key(orders.where(F.col("o_orderkey") % 3 == third), "o_custkey", ["o_orderdate", "o_orderkey"])
        parts.write_part(batch.select(*orders.columns), path, version)
        if version == 2:
            parts.compact(spark, path, orders.schema, "o_custkey", 2, guard="rank")
    merged = parts.latest(spark, path, orders.schema, "o_custkey", guard="rank")
    return merged.select("o_custkey", "o_orderkey", "o_totalprice")


# --- batch reader: time travel -----------------------------------------------------------


def q_current_state(spark, sf_dir):
    return timetravel.current_state(_history_table(spark, sf_dir))


def q_asof_snapshot(spark, sf_dir):
    return timetravel.asof_snapshot(_history_table(spark, sf_dir), T)


def q_asof_snapshot_rows(spark, sf_dir):
    return timetravel.asof_snapshot_rows(_changes(spark, sf_dir), T)


def q_replay_after(spark, sf_dir):
    return timetravel.replay_after(_history_table(spark, sf_dir), T)


def q_replay_after_ids(spark, sf_dir):
    ids = timefmt.parse_ids(REPLAY_IDS)
    changes = transitions.transitions(src.events_from_table(spark, sf_dir, ids=ids))
    return timetravel.replay_after_rows(changes, T, ids=ids)


def q_replay_from_log(spark, sf_dir):
    """Replay read from the stored change log: date-ranged Parquet files, so the
    ``date_event > T`` filter is pushed to the scan and skips earlier files."""
    from ..sources.files import read_change_log, write_change_log

    path = shared_path(spark, "changelog", unique=True)
    write_change_log(_changes(spark, sf_dir), path)
    return timetravel.replay_after_rows(read_change_log(spark, path), T)


def q_array_ops(spark, sf_dir):
    table = _history_table(spark, sf_dir)
    t = F.lit(T)
    per_row = table.select(
        ID,
        F.size("date_event_memory").alias("n"),
        F.size(F.filter("date_event_memory", lambda x: x <= t)).alias("n_before"),
        F.try_element_at(F.filter("date_event_memory", lambda x: x > t), F.lit(1)).alias("first_after"),
        F.array_max(F.transform("coordinates_memory", lambda c: F.get(c, 0))).alias("max_lat"),
    )
    return per_row.groupBy(ID).agg(
        F.sum("n").cast("long").alias("n_changes"),
        F.sum("n_before").cast("long").alias("n_before"),
        F.min("first_after").alias("first_after"),
        F.max("max_lat").alias("max_lat"),
    )


def q_parse_event_time(spark, sf_dir):
    ev = src.read_table(spark, sf_dir, "events")
    texts = ev.select(
        "event_id",
        F.date_format("ts", timefmt.DATE_FORMAT).alias("date_text"),
        F.date_format("ts", timefmt.TIME_FORMAT).alias("time_text"),
    )
    return texts.withColumn("t_millis", timefmt.event_time_millis("date_text", "time_text"))


# --- JSON sinks and sources --------------------------------------------------------------


def q_encode_event_json(spark, sf_dir):
    return jsonio.decode_events(jsonio.encode_events(_changes(spark, sf_dir)))


def q_encode_history_json(spark, sf_dir):
    rows = hist.history_rows(_changes(spark, sf_dir))
    return hist.history_text(jsonio.decode_history(jsonio.encode_history(rows)))


def q_decode_history_json(spark, sf_dir):
    rows = hist.history_rows(_changes(spark, sf_dir))
    records = jsonio.encode_history(rows).select(F.col("value").cast("binary").alias("value"))
    return hist.history_text(jsonio.decode_history(records))


def q_replay_json_single_file(spark, sf_dir):
    """The replay as one sequence: date-ranged part files, in order by name."""
    from ..sources.files import read_replay_json, write_replay_json

    path = shared_path(spark, "replay", str(T), unique=True)
    write_replay_json(timetravel.replay_after(_history_table(spark, sf_dir), T, sort=False), path)
    return read_replay_json(spark, path)


def q_replay_json_roundtrip(spark, sf_dir):
    from ..sources.files import read_replay_json, write_replay_json

    path = shared_path(spark, "replay", str(T), unique=True)
    write_replay_json(timetravel.replay_after(_history_table(spark, sf_dir), T, sort=False), path)
    return read_replay_json(spark, path)


def catalogue() -> dict[str, Query]:
    from ..streaming import jobs

    return {
        "parse_events": q_parse_events,
        "transitions": q_transitions,
        "transitions_hot_key": q_transitions_hot_key,
        "transitions_out_of_order": q_transitions_out_of_order,
        "late_rejected": q_late_rejected,
        "change_kind": q_change_kind,
        "history_rows": q_history_rows,
        "history_rows_nulls": q_history_rows_nulls,
        "parse_rejects": q_parse_rejects,
        "parse_types": q_parse_types,
        "latest_ties": q_latest_ties,
        "latest_per_key": q_latest_per_key,
        "ensure_table": q_ensure_table,
        "upsert_merge": q_upsert_merge,
        "table_at_version": q_table_at_version,
        "asof_stored": q_asof_stored,
        "replay_stored": q_replay_stored,
        "merge_latest": q_merge_latest,
        "current_state": q_current_state,
        "asof_snapshot": q_asof_snapshot,
        "asof_snapshot_rows": q_asof_snapshot_rows,
        "replay_after": q_replay_after,
        "replay_after_ids": q_replay_after_ids,
        "replay_from_log": q_replay_from_log,
        "array_ops": q_array_ops,
        "parse_event_time": q_parse_event_time,
        "encode_event_json": q_encode_event_json,
        "encode_history_json": q_encode_history_json,
        "decode_history_json": q_decode_history_json,
        "replay_json_roundtrip": q_replay_json_roundtrip,
        "replay_json_single_file": q_replay_json_single_file,
        "stream_out_of_order": jobs.q_stream_out_of_order,
        "stream_late_rejected": jobs.q_stream_late_rejected,
        "stream_state": jobs.q_stream_state,
        "stream_hot_key": jobs.q_stream_hot_key,
        "stream_parts_current": jobs.q_stream_parts_current,
        "stream_rejects": jobs.q_stream_rejects,
        "stream_parse_events": jobs.q_stream_parse_events,
        "stream_transitions": jobs.q_stream_transitions,
        "stream_history_rows": jobs.q_stream_history_rows,
        "stream_upsert_latest": jobs.q_stream_upsert_latest,
    }


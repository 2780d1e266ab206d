"""The three jobs as command lines.

    python -m eventide.cli first-hop  --brokers B --topic-in T1 --topic-out T2 --topic-flat T3 --checkpoint DIR
    python -m eventide.cli second-hop --brokers B --topic T2 --table DIR --checkpoint DIR
    python -m eventide.cli reader     --table DIR --date 01/01/2016 --time 14:59:00 --ids no-id --out DIR

``first-hop``: JSON events -> keyed transition filter -> history rows and flat
changes as JSON to two topics.  ``second-hop``: history rows -> latest per key
per micro-batch -> MERGE into the table.  ``reader``: the table -> state of every
key as of the date/time (shown) and the changes after it (written as JSON
lines under ``out/<millis>``).  Input field names come from ``--fields``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .functions import timefmt
from .operators import history as hist
from .operators import timetravel
from .schema import ColumnMapping
from .session import ensure_checkpoint_dir, ship_package
from .sources import events as src
from .sources import files, parts, table
from .streaming import jobs


def _mapping(text: str | None) -> ColumnMapping:
    if not text:
        return ColumnMapping()
    names = [p.strip() for p in text.split(",")]
    if len(names) != 6:
        raise SystemExit("--fields needs six names: id,event_type,date_event,lat,lng,location")
    return ColumnMapping(*names)


def first_hop(spark: SparkSession, a) -> None:
    """One keyed state; history rows and flat changes go to their topics from
    the same micro-batch."""
    messages = src.kafka_messages(spark, a.brokers, a.topic_in, max_offsets_per_trigger=a.max_offsets)
    mapping = _mapping(a.fields)
    jobs.first_hop_both(
        messages,
        jobs.kafka_writer(a.brokers, a.topic_out),
        jobs.kafka_writer(a.brokers, a.topic_flat),
        a.checkpoint,
        mapping=mapping,
        coercion=a.coercion,
        list_state=a.list_state,
        write_late=jobs.kafka_writer(a.brokers, a.late) if a.late else None,
    )
    if a.rejects:
        jobs.write_rejects(
            messages,
            jobs.kafka_writer(a.brokers, a.rejects),
            f"{a.checkpoint.rstrip('/')}-rejects",
            mapping=mapping,
            coercion=a.coercion,
        )
    spark.streams.awaitAnyTermination()


def second_hop(spark: SparkSession, a) -> None:
    messages = src.kafka_messages(
        spark, a.brokers, a.topic, fail_on_data_loss=False, max_offsets_per_trigger=a.max_offsets
    )
    guard = None if a.unguarded else "date_event"
    query = jobs.upsert_stream(
        messages.select("value"), a.table, a.checkpoint, guard=guard, available_now=False, fmt=a.format
    )
    query.awaitTermination()


def reader(spark: SparkSession, a) -> None:
    at = timefmt.event_time_literal(spark, a.date, a.time)
    if at is None:
        raise SystemExit(f"not a valid date/time: {a.date} {a.time}")
    if a.format == "parquet" and parts.exists(spark, a.table):
        hist_table = parts.read_parts(spark, a.table, hist.SEGMENT_ROW, upto=a.version)
    else:
        hist_table = table.read_table(spark, a.table, version=a.version, fmt=a.format)
    print("current state")
    timetravel.current_state(hist_table).select("id", "event_type", "date_event", "location").show()
    print(f"state as of {at}")
    timetravel.asof_snapshot(hist_table, at).show()
    ids = timefmt.parse_ids(a.ids)
    replay = timetravel.replay_after(hist_table, at, ids=ids, sort=False)
    out = f"{a.out.rstrip('/')}/{at}"
    files.write_replay_json(replay, out, single_file=a.single_file)
    print(f"changes after {at} written to {out}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="eventide")
    sub = p.add_subparsers(dest="job", required=True)
    f = sub.add_parser("first-hop")
    f.add_argument("--brokers", required=True)
    f.add_argument("--topic-in", required=True)
    f.add_argument("--topic-out", required=True)
    f.add_argument("--topic-flat", required=True)
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--fields", default=None)
    f.add_argument("--max-offsets", type=int, default=jobs.MAX_OFFSETS_PER_TRIGGER)
    f.add_argument("--rejects", default=None, help="topic for the messages that are no events")
    f.add_argument("--late", default=None, help="topic for the rejected late events")
    f.add_argument("--coercion", default="null", choices=["null", "zero", "typed"])
    f.add_argument("--list-state", action="store_true", help="history as ListState; fixed for a checkpoint's life")
    s = sub.add_parser("second-hop")
    s.add_argument("--brokers", required=True)
    s.add_argument("--topic", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--unguarded", action="store_true", help="update matched keys even with older dates")
    s.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    s.add_argument("--max-offsets", type=int, default=jobs.MAX_OFFSETS_PER_TRIGGER)
    r = sub.add_parser("reader")
    r.add_argument("--table", required=True)
    r.add_argument("--date", required=True, help="dd/MM/yyyy")
    r.add_argument("--time", required=True, help="HH:mm:ss")
    r.add_argument("--ids", default=timefmt.ALL_IDS)
    r.add_argument("--out", required=True)
    r.add_argument("--version", type=int, default=None)
    r.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    r.add_argument("--single-file", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"eventide-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    {"first-hop": first_hop, "second-hop": second_hop, "reader": reader}[a.job](spark, a)


if __name__ == "__main__":
    main()


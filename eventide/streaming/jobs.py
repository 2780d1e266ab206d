"""Streaming jobs: first hop (messages -> changes / history rows) and second hop
(history rows -> latest per key -> MERGE into the table).

Sources are Kafka topics in production (``sources.events.kafka_messages``) and
folders of JSON-lines files here; sinks are Kafka topics (``kafka_writer``), Parquet
folders or ``foreachBatch``.  A ``foreachBatch`` sink is at least once: a batch that
failed half-way is given again, with the same number.  Every query has a checkpoint under the shared
checkpoint folder, so a restarted query resumes its offsets and its keyed state.

The ``q_*`` functions drive the jobs over the driver's ``events`` table: the
table is cut into two arrival windows written as message files, the query runs
once per window (``availableNow``, restarted from its checkpoint in between)
and the output folder is read back.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonio
from ..operators import history as hist
from ..operators import latest, timetravel, transitions
from ..schema import DATE_EVENT, FLAT_COLUMNS, ID, SEQ, ColumnMapping
from ..session import ensure_checkpoint_dir, shared_path, ship_package
from ..sources import events as src
from ..sources import table as tbl
from . import batchfold
from .processor import keyed_transitions, keyed_transitions_tws, last_changes

# Fixed split of the test stream into two arrival windows (2024-01-15 UTC).
WINDOW_SPLIT = 1705276800000
# Default cap on records per micro-batch from Kafka: it bounds what one key's
# group (and so one stateful task) holds in a batch.
MAX_OFFSETS_PER_TRIGGER = 20_000_000


def first_hop(
    messages: DataFrame,
    history: bool = False,
    mapping: ColumnMapping = ColumnMapping(),
    coercion: str = "null",
    list_state: bool = False,
    late: bool = False,
) -> DataFrame:
    """Messages (``value``, ``seq``) -> parsed events -> keyed transition filter.

    ``list_state`` keeps a key's history as ``ListState`` (appends per change; needs the
    RocksDB state store) and not as one ``GroupState`` row.  It is part of the stream's
    identity: a checkpoint can only be continued with the form that it was begun with.
    ``late`` keeps the rejected late events in the output, marked.  What is no event (no key,
    type or date) goes to :func:`rejects`."""
    parsed = src.parse_events(messages, mapping, coercion=coercion, keep=[SEQ])
    good, _ = src.split_valid(parsed)
    form = keyed_transitions_tws if list_state else keyed_transitions
    return form(good, history=history, late=late)


def rejects(messages: DataFrame, mapping: ColumnMapping = ColumnMapping(), coercion: str = "null") -> DataFrame:
    """The messages that are no events under ``coercion``, the first hop's own: ``seq`` and the
    message's text, as it came."""
    messages = messages.withColumn("value", F.col("value").cast("string"))
    parsed = src.parse_events(messages, mapping, coercion=coercion, keep=[SEQ, "value"])
    _, bad = src.split_valid(parsed)
    return bad.select(SEQ, "value")


def write_rejects(
    messages: DataFrame,
    write,
    checkpoint: str,
    available_now: bool = False,
    mapping: ColumnMapping = ColumnMapping(),
    coercion: str = "null",
):
    """A stateless stream of :func:`rejects` to ``write(df, batch_id)``."""
    writer = rejects(messages, mapping, coercion).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def flat_from_history(rows: DataFrame, *more: str) -> DataFrame:
    """The flat change of each history row (all outputs come from one operator)."""
    return rows.select(
        ID, "event_type", DATE_EVENT, F.get("coordinates", 0).alias("lat"), F.get("coordinates", 1).alias("lng"),
        "location", *more,
    )


def first_hop_both(
    messages: DataFrame,
    write_history,
    write_flat,
    checkpoint: str,
    available_now: bool = False,
    mapping: ColumnMapping = ColumnMapping(),
    coercion: str = "null",
    list_state: bool = False,
    write_late=None,
):
    """First hop with ONE keyed state for all outputs: every micro-batch's
    history rows (with ``last_seq``) go to ``write_history(df, batch_id)``,
    their flat projection to ``write_flat(df, batch_id)`` and, if asked for, the late events to
    ``write_late(df, batch_id)`` (one shuffle, one state, instead of keyed operators of
    their own over the same stream).

    A batch that fails between two writes is given again, with the same number and rows:
    :func:`folder_writer` replaces what it had written, :func:`kafka_writer` repeats it."""

    def both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch
            if write_late is not None:
                write_late(flat_from_history(batch.where("late"), SEQ), batch_id)
                rows = batch.where("NOT late").drop("late")
            write_history(rows.withColumnRenamed(SEQ, "last_seq"), batch_id)
            write_flat(flat_from_history(rows), batch_id)
        finally:
            batch.unpersist()

    rows = first_hop(messages, True, mapping, coercion, list_state, late=write_late is not None)
    writer = rows.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def folder_writer(path: str, fmt: str = "parquet"):
    """``(df, batch_id)`` callback writing each batch to a folder of its own, ``batch=<number>``: a
    batch that is given again replaces its rows.  The parent reads as one table."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def kafka_writer(bootstrap_servers: str, topic: str):
    """``(df, batch_id)`` callback writing JSON rows to a Kafka topic.  The record key is
    the row's id: all rows of an id go to one topic partition, in order."""

    def write(df: DataFrame, batch_id: int) -> None:
        (jsonio.keyed(df).write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic).save())

    return write


def run_available(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available now into a file sink, then stop."""
    q = (
        df.writeStream.format(fmt)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def upsert_stream(
    history_messages: DataFrame,
    table_path: str,
    checkpoint: str,
    guard: str | None = DATE_EVENT,
    available_now: bool = True,
    fmt: str = "parquet",
):
    """Second hop: decode history rows, keep the latest per key in each micro-batch, MERGE
    into the table (``fmt="delta"``: a Delta table).

    The new version follows the table's own last one, whatever the stream's batch number
    is: a stream with a new checkpoint goes on where the table is.  A batch that is given
    again changes nothing, as its rows are in the table already and the guard lets no
    older row replace a newer one."""
    spark = history_messages.sparkSession
    tbl.ensure_table(spark, table_path, hist.TABLE_ROW, fmt)
    rows = jsonio.decode(history_messages, hist.TABLE_ROW)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        one = latest.latest_per_key(batch.where(F.col(ID).isNotNull()), ID,
                                    [DATE_EVENT, F.size("date_event_memory"), "last_seq"])
        one = one.persist()
        try:
            tbl.upsert(spark, table_path, one, ID, guard=guard, fmt=fmt)
        finally:
            one.unpersist()

    writer = rows.writeStream.foreachBatch(merge_batch).outputMode("update").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# --- registered queries -------------------------------------------------------------------


def _windows():
    return (F.col(DATE_EVENT) <= WINDOW_SPLIT, F.col(DATE_EVENT) > WINDOW_SPLIT)


@contextmanager
def _state_partitions(spark: SparkSession):
    """Start the test streams with one state partition per core (a stateful
    query keeps the count it started with in its checkpoint)."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _prepare(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return shared_path(spark, "streams", unique=True)


def _run_two_windows(
    spark: SparkSession, sf_dir: str, history: bool, parse_only: bool = False, arrival: str = "event_id"
) -> DataFrame:
    base = _prepare(spark)
    events = src.events_from_table(spark, sf_dir, arrival)
    windows = _windows()
    if arrival != "event_id":
        half = int(events.agg(F.expr(f"percentile({SEQ}, 0.5)")).first()[0] or 0)
        windows = (F.col(SEQ) <= half, F.col(SEQ) > half)
    out, ckpt = f"{base}/out", f"{base}/checkpoint"
    for i, window in enumerate(windows):
        # The source folder grows by one window per run; the restarted query
        # resumes from its checkpoint (file offsets and keyed state).
        src.to_input_json(events.where(window)).write.mode("overwrite").json(f"{base}/in/w{i}")
        stream = spark.readStream.schema("value string, seq long").json(f"{base}/in/*")
        result = src.parse_events(stream, keep=[SEQ]) if parse_only else first_hop(stream, history=history)
        with _state_partitions(spark):
            run_available(result, out, ckpt)
    return spark.read.parquet(out)


def q_stream_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _run_two_windows(spark, sf_dir, history=False, parse_only=True)
    good, _ = src.split_valid(parsed)
    return good.select(*FLAT_COLUMNS, SEQ)


def q_stream_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_two_windows(spark, sf_dir, history=False).select(*FLAT_COLUMNS)


def q_stream_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled arrival in two windows: late and tied events meet the state of the first."""
    return _run_two_windows(spark, sf_dir, history=False, arrival="shuffled").select(*FLAT_COLUMNS)


def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh message has no type: the rejects stream carries exactly those."""
    base = _prepare(spark)
    messages = src.to_input_json(src.events_from_table(spark, sf_dir).withColumn(
        "event_type", F.when(F.col(SEQ) % 11 != 0, F.col("event_type"))))
    messages.write.mode("overwrite").json(f"{base}/in")
    stream = spark.readStream.schema("value string, seq long").json(f"{base}/in")
    out = f"{base}/rejects"
    write_rejects(stream, lambda df, i: df.write.mode("append").parquet(out), f"{base}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(out).select(SEQ, (F.length("value") > 0).alias("has_text"))


def _message_windows(spark: SparkSession, base: str, events: DataFrame, windows):
    """The stream of the message files under ``base``, once for each arrival window added to them."""
    for i, window in enumerate(windows):
        src.to_input_json(events.where(window)).write.mode("overwrite").json(f"{base}/in/w{i}")
        yield spark.readStream.schema("value string, seq long").json(f"{base}/in/*")


def _halves(events: DataFrame):
    half = int(events.agg(F.expr(f"percentile({SEQ}, 0.5)")).first()[0] or 0)
    return F.col(SEQ) <= half, F.col(SEQ) > half


def q_stream_late_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled arrival in two windows: the late events of the running stream, from the operator
    that also gives the changes."""
    base = _prepare(spark)
    events = src.events_from_table(spark, sf_dir, "shuffled")
    for stream in _message_windows(spark, base, events, _halves(events)):
        decided = first_hop(stream, late=True)

        def write(df: DataFrame, batch_id: int) -> None:
            folder_writer(f"{base}/out")(df, batch_id)

        with _state_partitions(spark):
            query = decided.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
            query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").where("late").select(*FLAT_COLUMNS)


def q_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed state that a stream has after two windows, read from its checkpoint."""
    base = _prepare(spark)
    events = src.events_from_table(spark, sf_dir, "shuffled")
    for stream in _message_windows(spark, base, events, _halves(events)):
        with _state_partitions(spark):
            run_available(first_hop(stream), f"{base}/out", f"{base}/checkpoint")
    return last_changes(spark, f"{base}/checkpoint")


def _fold_stream(spark: SparkSession, events: DataFrame, windows) -> str:
    base = _prepare(spark)
    for stream in _message_windows(spark, base, events, windows):
        good, _ = src.split_valid(src.parse_events(stream, keep=[SEQ]))
        batchfold.fold_stream(good, f"{base}/tables", f"{base}/checkpoint", available_now=True).awaitTermination()
    return f"{base}/tables"


def q_stream_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all events on one key, folded batch by batch over as many tasks as they need."""
    events = src.events_from_table(spark, sf_dir)
    events = events.withColumn(ID, F.when(F.col(SEQ) % 3 == 0, F.lit("hot")).otherwise(F.col(ID)))
    path = _fold_stream(spark, events, _windows())
    return batchfold.changes(spark, path).select(*FLAT_COLUMNS)


def q_stream_parts_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest change per key from the history segments that the batches added."""
    path = _fold_stream(spark, src.events_from_table(spark, sf_dir), _windows())
    return timetravel.current_state(batchfold.segments(spark, path))


def q_stream_history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.history_text(_run_two_windows(spark, sf_dir, history=True))


def q_stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second hop over history-row messages in two arrival windows."""
    base = _prepare(spark)
    changes = transitions.transitions(src.events_from_table(spark, sf_dir))
    rows = hist.history_rows(changes).withColumnRenamed(SEQ, "last_seq")
    table_path = f"{base}/table"
    for i, window in enumerate(_windows()):
        jsonio.encode(rows.where(window)).write.mode("overwrite").json(f"{base}/in/w{i}")
        stream = spark.readStream.schema("value string").json(f"{base}/in/*")
        with _state_partitions(spark):
            query = upsert_stream(stream, table_path, f"{base}/checkpoint")
        query.awaitTermination()
    return timetravel.current_state(tbl.read_table(spark, table_path))

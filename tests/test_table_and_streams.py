"""Versioned table upsert and the streaming jobs (restart from checkpoint)."""

import random

from conftest import SF001, make_events
from pyspark.sql import functions as F

from eventide.operators import fold
from eventide.session import shared_path
from eventide.sources import table as tbl
from eventide.streaming import processor


def test_table_versions_and_guard(spark):
    path = shared_path(spark, "test-table", unique=True)
    schema = "id string, date_event long, v string"
    assert tbl.ensure_table(spark, path, spark.createDataFrame([], schema).schema) == 0
    s1 = spark.createDataFrame([("a", 5, "x"), ("b", 1, "y")], schema)
    assert tbl.upsert(spark, path, s1, "id", version=1, guard="date_event") == 1
    s2 = spark.createDataFrame([("a", 3, "old"), ("c", 2, "z")], schema)
    tbl.upsert(spark, path, s2, "id", version=2, guard="date_event")
    got = sorted(tuple(r) for r in tbl.read_table(spark, path).collect())
    assert got == [("a", 5, "x"), ("b", 1, "y"), ("c", 2, "z")]
    # unguarded: the unconditional update
    tbl.upsert(spark, path, s2, "id", version=2, guard=None)
    got = sorted(tuple(r) for r in tbl.read_table(spark, path).collect())
    assert got == [("a", 3, "old"), ("b", 1, "y"), ("c", 2, "z")]
    assert sorted(tuple(r) for r in tbl.read_table(spark, path, version=1).collect()) == [("a", 5, "x"), ("b", 1, "y")]
    assert tbl.ensure_table(spark, path, spark.createDataFrame([], schema).schema) == 2


def _stream_vs_fold(spark, rows, batches, use_tws=False):
    base = shared_path(spark, "test-stream", unique=True)
    events = make_events(spark, rows)
    seqs = sorted(r[3] for r in rows)
    cuts = [seqs[len(seqs) * i // batches] for i in range(1, batches)]
    bounds = [-1, *cuts, seqs[-1] + 1]
    schema = events.schema
    out, ckpt = f"{base}/out", f"{base}/ckpt"
    for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        events.where((F.col("seq") > lo) & (F.col("seq") <= hi)).write.parquet(f"{base}/in/b{i}")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in/*")
        op = processor.keyed_transitions_tws if use_tws else processor.keyed_transitions
        q = (op(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = {(r.id, r.seq) for r in spark.read.parquet(out).collect()}
    want = set()
    by_key = {}
    for k, t, d, s in sorted(rows, key=lambda r: (r[0], r[3])):
        by_key.setdefault(k, []).append((t, d, s))
    for k, evs in by_key.items():
        for (t, d, s), x in zip(evs, fold.fold_reference([(t, d) for t, d, _ in evs])):
            if x == fold.ACCEPTED:
                want.add((k, s))
    return got, want


def test_stream_equals_fold_across_restarts(spark):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 6)}", rnd.choice("ABC"), rnd.randint(0, 40), s) for s in range(300)]
    got, want = _stream_vs_fold(spark, rows, batches=3)
    assert got == want


def test_stream_transform_with_state(spark):
    rnd = random.Random(8)
    rows = [(f"k{rnd.randint(0, 4)}", rnd.choice("AB"), rnd.randint(0, 30), s) for s in range(120)]
    got, want = _stream_vs_fold(spark, rows, batches=2, use_tws=True)
    assert got == want


def test_stream_queries_on_driver_table(spark):
    from eventide.streaming import jobs

    n = jobs.q_stream_transitions(spark, SF001).count()
    assert n == 802
    assert jobs.q_stream_upsert_latest(spark, SF001).count() == 15


def test_replayed_batch_changes_nothing(spark):
    """A micro-batch that is given again leaves the table's rows as they are."""
    path = shared_path(spark, "test-idem", unique=True)
    schema = "id string, date_event long, v string"
    tbl.ensure_table(spark, path, spark.createDataFrame([], schema).schema)
    b0 = spark.createDataFrame([("a", 1, "x")], schema)
    b1 = spark.createDataFrame([("a", 2, "y"), ("b", 1, "z")], schema)
    for batch in (b0, b1):
        tbl.upsert(spark, path, batch, "id", guard="date_event")
    first = sorted(tuple(r) for r in tbl.read_table(spark, path).collect())
    for batch in (b1, b0):
        tbl.upsert(spark, path, batch, "id", guard="date_event")
    assert sorted(tuple(r) for r in tbl.read_table(spark, path).collect()) == first == [("a", 2, "y"), ("b", 1, "z")]


def test_second_hop_with_a_new_checkpoint_goes_on(spark):
    """A stream that lost its checkpoint updates the table it finds."""
    from eventide.functions import jsonio
    from eventide.operators import history as hist
    from eventide.operators import transitions as tr
    from eventide.streaming import jobs

    base = shared_path(spark, "test-new-checkpoint", unique=True)
    rows = [("a", "A", 1, 0), ("a", "B", 5, 1), ("b", "A", 2, 2), ("a", "C", 9, 3), ("c", "A", 7, 4)]
    changes = tr.transitions(make_events(spark, rows), num_partitions=2)
    history = hist.history_rows(changes).withColumnRenamed("seq", "last_seq")
    for i, window in enumerate((F.col("date_event") < 6, F.col("date_event") >= 6)):
        jsonio.encode(history.where(window)).write.json(f"{base}/in{i}")
        stream = spark.readStream.schema("value string").json(f"{base}/in{i}")
        jobs.upsert_stream(stream, f"{base}/table", f"{base}/checkpoint{i}").awaitTermination()
    got = {r.id: r.date_event for r in tbl.read_table(spark, f"{base}/table").collect()}
    assert got == {"a": 9, "b": 2, "c": 7}


def test_rejects_are_kept(spark):
    from eventide.streaming import jobs

    base = shared_path(spark, "test-rejects", unique=True)
    good = '{"ID":"a","EVENT_TYPE":"A","DATE_EVENT":1,"LAT":1.0,"LNG":2.0,"LOCATION":"x"}'
    rows = [(good, 0), ("not json", 1), (None, 2), (good.replace("DATE_EVENT", "DATE"), 3)]
    spark.createDataFrame(rows, "value string, seq long").write.json(f"{base}/in")
    stream = spark.readStream.schema("value string, seq long").json(f"{base}/in")
    jobs.write_rejects(stream, lambda df, i: df.write.mode("append").parquet(f"{base}/out"), f"{base}/c", available_now=True).awaitTermination()
    got = {(r.seq, r.value) for r in spark.read.parquet(f"{base}/out").collect()}
    names = jobs.ColumnMapping().as_dict()
    assert {s for s, _ in got} == ({1, 2, 3} if names["date_event"] == "DATE_EVENT" else {0, 1, 2, 3})
    assert (1, "not json") in got and (2, None) in got


def test_history_stream_with_list_state(spark):
    """transformWithStateInPandas history rows equal the batch history rows."""
    from eventide.operators import history as hist
    from eventide.operators import transitions as tr

    rnd = random.Random(4)
    rows = [(f"k{rnd.randint(0, 3)}", rnd.choice("AB"), s // 2, s) for s in range(80)]
    # NULL places, latitudes and longitudes stay in their positions in both forms.
    events = make_events(spark, rows).withColumns({
        c: F.when(F.col("seq") % n != 0, F.col(c)) for c, n in (("location", 3), ("lat", 4), ("lng", 5))
    })
    base = shared_path(spark, "test-hist-stream", unique=True)
    out, ckpt = f"{base}/out", f"{base}/ckpt"
    for i, (lo, hi) in enumerate(((-1, 39), (39, 80))):
        events.where((F.col("seq") > lo) & (F.col("seq") <= hi)).write.parquet(f"{base}/in/b{i}")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in/*")
        q = (processor.keyed_transitions_tws(stream, history=True).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    columns = ["id", "seq", *hist.MEMORY_COLUMNS]
    got = sorted(map(str, spark.read.parquet(out).select(columns).collect()))
    want = sorted(map(str, hist.history_rows(tr.transitions(events, num_partitions=2)).select(columns).collect()))
    assert got == want


def test_cli_reader_job(spark, capsys):
    """reader: table -> snapshot shown, replay for selected ids written as JSON."""
    from eventide import cli
    from eventide.operators import timetravel
    from eventide.operators import transitions as tr
    from eventide.plans import catalogue
    from eventide.sources.events import events_from_table
    from eventide.sources.files import read_replay_json

    path = catalogue._two_batch_table(spark, SF001)
    out = shared_path(spark, "test-cli-out", unique=True)
    cli.main(["reader", "--table", path, "--date", "15/01/2024", "--time", "00:00:00", "--ids", "3,7", "--out", out])
    assert "state as of 1705276800000" in capsys.readouterr().out
    got = sorted(tuple(r) for r in read_replay_json(spark, f"{out}/1705276800000").collect())
    changes = tr.transitions(events_from_table(spark, SF001))
    want = sorted(tuple(r) for r in timetravel.replay_after_rows(changes, 1705276800000, ids=["3", "7"]).collect())
    assert got == want and len(got) > 0


def test_first_hop_one_state_two_outputs(spark):
    """History rows and flat changes come from one keyed state per micro-batch
    and equal the batch forms, across a restart."""
    from eventide.operators import history as hist
    from eventide.operators import transitions as tr
    from eventide.sources.events import events_from_table, to_input_json
    from eventide.streaming import jobs

    events = events_from_table(spark, SF001)
    base = shared_path(spark, "test-first-hop", unique=True)

    def parquet_writer(path):
        return lambda df, batch_id: df.write.mode("append").parquet(path)

    for i, window in enumerate((F.col("date_event") <= 1705276800000, F.col("date_event") > 1705276800000)):
        to_input_json(events.where(window)).write.json(f"{base}/in/w{i}")
        stream = spark.readStream.schema("value string, seq long").json(f"{base}/in/*")
        jobs.first_hop_both(stream, parquet_writer(f"{base}/hist"), parquet_writer(f"{base}/flat"),
                            f"{base}/ckpt", available_now=True).awaitTermination()
    changes = tr.transitions(events)
    flat = sorted(tuple(r) for r in spark.read.parquet(f"{base}/flat").collect())
    assert flat == sorted(tuple(r) for r in changes.select("id", "event_type", "date_event", "lat", "lng", "location").collect())
    got = sorted(tuple(r) for r in hist.history_text(spark.read.parquet(f"{base}/hist")).collect())
    assert got == sorted(tuple(r) for r in hist.history_text(hist.history_rows(changes)).collect())


def test_file_message_stream_with_custom_mapping(spark):
    """json_file_messages (the Kafka twin) feeding the first hop with custom
    field names gives the batch transitions."""
    from eventide.operators import transitions as tr
    from eventide.schema import ColumnMapping
    from eventide.sources.events import events_from_table, json_file_messages, to_input_json
    from eventide.streaming import jobs

    mapping = ColumnMapping("trainId", "kind", "when", "y", "x", "place")
    events = events_from_table(spark, SF001)
    base = shared_path(spark, "test-file-stream", unique=True)
    to_input_json(events, mapping).write.json(f"{base}/in")
    stream = json_file_messages(spark, f"{base}/in", max_files_per_trigger=1)
    out = f"{base}/flat"
    jobs.first_hop_both(stream, lambda df, i: None, lambda df, i: df.write.mode("append").parquet(out),
                        f"{base}/ckpt", available_now=True, mapping=mapping).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r) for r in tr.transitions(events).select("id", "event_type", "date_event", "lat", "lng", "location").collect())
    assert got == want

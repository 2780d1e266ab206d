"""Tables of parts, the batch-fold stream, late outputs and outputs that survive a repeated batch."""

import random

import pytest
from conftest import make_events
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_transitions_spark import _expected

from eventide.functions import jsonio
from eventide.operators import fold, timetravel
from eventide.operators import history as hist
from eventide.operators import transitions as tr
from eventide.session import shared_path
from eventide.sources import events as src
from eventide.sources import files, parts
from eventide.streaming import batchfold, jobs, processor

KEYED = T.StructType([T.StructField("id", T.StringType()), T.StructField("d", T.LongType()), T.StructField("v", T.StringType())])


def part(spark, *rows):
    return spark.createDataFrame(list(rows), KEYED)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_parts_follow_the_batches(spark):
    path = shared_path(spark, "test-parts", unique=True)
    parts.ensure(spark, path, KEYED)
    parts.write_part(part(spark, ("a", 5, "x"), ("b", 1, "y")), path, 1)
    parts.write_part(part(spark, ("a", 3, "old"), ("c", 2, "z")), path, 2)
    parts.ensure(spark, path, KEYED)
    assert values(parts.latest(spark, path, KEYED, "id")) == [("a", 3, "old"), ("b", 1, "y"), ("c", 2, "z")]
    assert values(parts.latest(spark, path, KEYED, "id", guard="d")) == [("a", 5, "x"), ("b", 1, "y"), ("c", 2, "z")]
    assert values(parts.latest(spark, path, KEYED, "id", upto=1)) == [("a", 5, "x"), ("b", 1, "y")]
    parts.write_part(part(spark, ("a", 4, "again")), path, 2)  # the batch is given again, with other rows
    assert values(parts.read_parts(spark, path, KEYED).drop("version")) == [("a", 4, "again"), ("a", 5, "x"), ("b", 1, "y")]
    before = values(parts.latest(spark, path, KEYED, "id", guard="d"))
    parts.compact(spark, path, KEYED, "id", 2, guard="d")
    assert values(parts.latest(spark, path, KEYED, "id", guard="d")) == before
    assert values(parts.latest(spark, path, KEYED, "id", upto=1)) == [("a", 5, "x"), ("b", 1, "y")]
    parts.write_part(part(spark, ("b", 9, "new")), path, 3)
    assert values(parts.latest(spark, path, KEYED, "id", guard="d")) == [("a", 5, "x"), ("b", 9, "new")]
    with pytest.raises(ValueError):
        parts.write_part(part(spark), path, 0)


def test_written_bytes_follow_the_batch(spark):
    """A small batch writes one small part, whatever the table holds."""
    path = shared_path(spark, "test-bytes", unique=True)
    parts.ensure(spark, path, KEYED)
    big = spark.range(200_000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    parts.write_part(big, path, 1)
    parts.write_part(part(spark, ("7", 900_000, "x")), path, 2)
    sizes = parts.read_parts(spark, path, KEYED).select("version", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n")).distinct()
    size = {r.version: r.n for r in sizes.groupBy("version").agg(F.sum("n").alias("n")).collect()}
    assert size[2] * 1000 < size[1]


def test_segments_outside_the_date_are_not_read(spark):
    rows = [(f"k{i % 3}", "AB"[i % 2], i, i) for i in range(60)]
    changes = tr.transitions(make_events(spark, rows), num_partitions=2)
    path = shared_path(spark, "test-prune", unique=True)
    parts.ensure(spark, path, hist.SEGMENT_ROW)
    parts.write_part(hist.history_table(changes, segment_size=4).select(*hist.SEGMENT_ROW.names), path, 1)
    stored = parts.read_parts(spark, path, hist.SEGMENT_ROW)
    snapshot, replay = timetravel.asof_snapshot(stored, 20), timetravel.replay_after(stored, 50)
    assert "LessThanOrEqual(first_date,20)" in snapshot._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(date_event,50)" in replay._jdf.queryExecution().executedPlan().toString()
    plain = hist.history_table(changes)
    assert values(snapshot) == values(timetravel.asof_snapshot(plain, 20))
    assert values(replay) == values(timetravel.replay_after(plain, 50))


def _events(seed, n=240, types="ABC-"):
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 5)}", rnd.choice(types), rnd.randint(0, 40), s) for s in range(n)]


def _windows(spark, base, rows, cuts):
    """The stream's source grows by one file of events for each window."""
    events = make_events(spark, rows)
    for i, (lo, hi) in enumerate(zip([-1, *cuts], [*cuts, 1 << 40])):
        events.where((F.col("seq") > lo) & (F.col("seq") <= hi)).write.mode("overwrite").parquet(f"{base}/in/w{i}")
        yield spark.readStream.schema(events.schema).parquet(f"{base}/in/*")


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_fold_stream_equals_the_fold(spark, seed):
    """States enter the batches, of the initial state's type too; the hot key is in several chunks."""
    rows = _events(seed)
    base = shared_path(spark, "test-batchfold", unique=True)
    for stream in _windows(spark, base, rows, [80, 81, 160]):
        batchfold.fold_stream(stream, f"{base}/t", f"{base}/ck", available_now=True, num_partitions=5, segment_size=3).awaitTermination()
    acc, late = _expected(rows)
    path = f"{base}/t"
    assert {(r.id, r.seq) for r in batchfold.changes(spark, path).collect()} == acc
    assert {(r.id, r.seq) for r in batchfold.changes(spark, path, late=True).collect()} == late
    want = tr.transitions(make_events(spark, rows), num_partitions=3)
    assert values(timetravel.current_state(batchfold.segments(spark, path))) == values(timetravel.current_state(want))
    for at in (5, 20, 39):
        assert values(timetravel.asof_snapshot(batchfold.segments(spark, path), at)) == values(timetravel.asof_snapshot_rows(want, at))
    longest = batchfold.segments(spark, path).agg(F.max(F.size("date_event_memory"))).first()[0]
    assert longest <= 3
    decided = tr.annotate_transitions(make_events(spark, rows), num_partitions=5).where("id = 'hot'")
    assert decided.select("_pid").distinct().count() > 1


def test_batch_fold_survives_a_failure(spark, monkeypatch):
    """A batch that fails before its last table is given again: no row is lost or doubled."""
    rows = _events(7)
    base = shared_path(spark, "test-batchfold-fail", unique=True)
    write, failed = parts.write_part, []

    def once(df, path, version):
        if version == 2 and path.endswith("state") and not failed:
            failed.append(path)
            raise RuntimeError("lost")
        write(df, path, version)

    monkeypatch.setattr(parts, "write_part", once)
    for stream in _windows(spark, base, rows, [100]):
        for _ in range(2):
            try:
                batchfold.fold_stream(stream, f"{base}/t", f"{base}/ck", available_now=True).awaitTermination()
                break
            except StreamingQueryException:
                assert len(failed) == 1
    assert failed
    acc, late = _expected(rows)
    got = [(r.id, r.seq) for r in batchfold.changes(spark, f"{base}/t").collect()]
    assert len(got) == len(acc) and set(got) == acc


def _failing_first_hop(spark, base, rows, fail_at):
    """Both outputs and the late events to folders; the flat write of batch ``fail_at`` fails once."""
    failed = []
    flat = jobs.folder_writer(f"{base}/flat")

    def write_flat(df, batch_id):
        if batch_id == fail_at and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")
        flat(df, batch_id)

    schema = "value string, seq long"
    events = make_events(spark, rows)
    for i, window in enumerate((F.col("seq") <= 100, F.col("seq") > 100)):
        src.to_input_json(events.where(window)).write.mode("overwrite").json(f"{base}/in/w{i}")
        for _ in range(2):
            stream = spark.readStream.schema(schema).json(f"{base}/in/*")
            query = jobs.first_hop_both(
                stream, jobs.folder_writer(f"{base}/history"), write_flat, f"{base}/ck", available_now=True,
                write_late=jobs.folder_writer(f"{base}/late"),
            )
            try:
                query.awaitTermination()
                break
            except StreamingQueryException:
                assert failed == [fail_at]
    return failed


def test_outputs_survive_a_failure_between_two_writes(spark):
    rows = _events(11, types="ABC")
    base = shared_path(spark, "test-outputs", unique=True)
    assert _failing_first_hop(spark, base, rows, 1) == [1]
    acc, late = _expected(rows)
    by_seq = {r[3]: r for r in rows}
    history = [r.last_seq for r in spark.read.parquet(f"{base}/history").collect()]
    assert sorted(history) == sorted(s for _, s in acc)
    flat = sorted((r.id, r.event_type, r.date_event) for r in spark.read.parquet(f"{base}/flat").collect())
    assert flat == sorted((k, by_seq[s][1], by_seq[s][2]) for k, s in acc)
    got = {(r.id, r.seq) for r in spark.read.parquet(f"{base}/late").collect()}
    assert got == late and late


@pytest.mark.parametrize("tws", [False, True])
def test_late_rows_and_state_of_a_stream(spark, tws):
    rows = _events(5, n=150)
    base = shared_path(spark, "test-late", unique=True)
    form = processor.keyed_transitions_tws if tws else processor.keyed_transitions
    for stream in _windows(spark, base, rows, [70]):
        jobs.run_available(form(stream, history=True, late=True), f"{base}/out", f"{base}/ck")
    acc, late = _expected(rows)
    out = spark.read.parquet(f"{base}/out").collect()
    assert {(r.id, r.seq) for r in out if not r.late} == acc and {(r.id, r.seq) for r in out if r.late} == late
    assert all((r.date_event_memory is None) == r.late for r in out)
    last = {}
    for k, s in sorted(acc, key=lambda x: x[1]):
        last[k] = s
    by_seq = {r[3]: r for r in rows}
    want = sorted((k, by_seq[s][1], by_seq[s][2]) for k, s in last.items())
    assert values(processor.last_changes(spark, f"{base}/ck", tws)) == want


def test_rejects_follow_the_coercion(spark):
    messages = spark.createDataFrame([('{"ID":"a"}', 0), ("no json", 1), ('{"ID":"a","EVENT_TYPE":1,"DATE_EVENT":"7"}', 2)], "value string, seq long")
    got = {c: sorted(r.seq for r in jobs.rejects(messages, coercion=c).collect()) for c in ("null", "zero", "typed")}
    assert got == {"null": [0, 1], "zero": [], "typed": [0, 1]}


def test_fields_by_json_type(spark):
    cases = [("7", "7", 7, 7.0), ('"7"', "7", 7, 7.0), ("7.9", "7.9", 7, 7.9), ('" 7.9 "', " 7.9 ", 7, 7.9), ('"x"', "x", 0, 0.0), ("true", "true", 1, 1.0),
             ("false", "false", 0, 0.0), ("null", "null", 0, 0.0), ('{"a":1}', "", 0, 0.0), ("[1]", "", 0, 0.0), ("-3", "-3", -3, -3.0), ('""', "", 0, 0.0)]
    rows = [(f'{{"ID":{t},"EVENT_TYPE":{t},"DATE_EVENT":{t},"LAT":{t},"LNG":{t},"LOCATION":{t}}}', i) for i, (t, *_) in enumerate(cases)]
    df = spark.createDataFrame(rows, "value string, seq long")
    got = {r.seq: r for r in src.parse_events(df, coercion="typed", keep=["seq"]).collect()}
    for i, (t, text, long, double) in enumerate(cases):
        r = got[i]
        assert (r.id, r.event_type, r.location, r.date_event, r.lat, r.lng, r.valid) == (text, text, text, long, double, double, True), t


def test_replay_in_one_file_is_an_option(spark):
    rows = [(f"k{i % 3}", "AB"[i % 2], i, i) for i in range(40)]
    replay = timetravel.replay_after_rows(tr.transitions(make_events(spark, rows), num_partitions=2), 5)
    base = shared_path(spark, "test-one-file", unique=True)
    files.write_replay_json(replay, f"{base}/one", single_file=True)
    files.write_replay_json(replay, f"{base}/many", partitions=4)
    one, many = (files.read_replay_json(spark, f"{base}/{x}") for x in ("one", "many"))
    assert len(one.inputFiles()) == 1 < len(many.inputFiles()) and values(one) == values(many)
    dates = [[r.date_event for r in files.read_replay_json(spark, f).collect()] for f in sorted(many.inputFiles())]
    assert [d for part in dates for d in part] == sorted(d for part in dates for d in part)


def test_json_of_late_rows(spark):
    """Late events of the history form are written like other rows."""
    rows = [("a", "A", 5, 0), ("a", "B", 3, 1)]
    late = spark.createDataFrame(rows[1:], "id string, event_type string, date_event long, seq long")
    assert jsonio.keyed(late).count() == 1 and fold.fold_reference([r[1:3] for r in rows]) == [fold.ACCEPTED, fold.LATE]

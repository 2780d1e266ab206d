"""History arrays, time travel (array and row forms), latest per key."""

import random

from conftest import make_events
from pyspark.sql import functions as F

from eventide.operators import history as hist
from eventide.operators import latest, timetravel
from eventide.operators import transitions as tr


def _changes(spark, rows, parts=3):
    return tr.transitions(make_events(spark, rows), num_partitions=parts)


def test_history_of_simple_key(spark):
    rows = [("a", "A", 1, 0), ("a", "A", 2, 1), ("a", "B", 3, 2)]
    changes = _changes(spark, rows)
    h = hist.history_rows(changes).orderBy("seq").collect()
    assert h[-1].event_type_memory == ["A", "B"] and h[-1].date_event_memory == [1, 3]
    assert h[-1].coordinates_memory == [[0.1, 0.0], [0.3, 2.0]]
    table = hist.history_table(changes)
    snap2 = timetravel.asof_snapshot(table, 2).collect()
    assert [(r.event_type, r.date_event) for r in snap2] == [("A", 1)]
    assert [(r.event_type, r.date_event) for r in timetravel.replay_after(table, 2).collect()] == [("B", 3)]
    assert [(r.event_type, r.date_event) for r in timetravel.asof_snapshot(table, 3).collect()] == [("B", 3)]
    assert timetravel.replay_after(table, 3).count() == 0
    assert timetravel.asof_snapshot(table, 0).count() == 0


def test_array_and_row_forms_agree_with_segments(spark):
    rnd = random.Random(11)
    rows = [(f"k{rnd.randint(0, 5)}", rnd.choice("ABC"), s, s) for s in range(400)]
    changes = _changes(spark, rows, parts=5)
    # Tiny segments: keys span several history-table rows.
    table = hist.history_table(changes, segment_size=4)
    assert table.count() > table.select("id").distinct().count()
    for t in (-1, 50, 200, 399, 1000):
        a = sorted(map(tuple, timetravel.asof_snapshot(table, t).collect()))
        b = sorted(map(tuple, timetravel.asof_snapshot_rows(changes, t).collect()))
        assert a == b
        ra = sorted(map(tuple, timetravel.replay_after(table, t).collect()))
        rb = sorted(map(tuple, timetravel.replay_after_rows(changes, t).collect()))
        assert ra == rb
    cur_a = sorted(map(tuple, timetravel.current_state(table).collect()))
    cur_b = sorted(map(tuple, timetravel.current_state(changes).collect()))
    assert cur_a == cur_b


def test_snapshot_then_replay_partition_the_log(spark):
    """replay(T) plus the changes up to T is the whole change log, and the
    snapshot is each key's last change before its first replayed row."""
    rnd = random.Random(3)
    rows = [(f"k{rnd.randint(0, 7)}", rnd.choice("AB"), s // 2, s) for s in range(300)]
    changes = _changes(spark, rows)
    t = 70
    total = changes.count()
    before = changes.where(F.col("date_event") <= t).count()
    assert timetravel.replay_after_rows(changes, t).count() + before == total
    snap = {r.id: r.date_event for r in timetravel.asof_snapshot_rows(changes, t).collect()}
    assert all(d <= t for d in snap.values())


def test_replay_ids_and_order(spark):
    rows = [("a", "A", 5, 0), ("b", "A", 3, 1), ("a", "B", 7, 2), ("c", "A", 9, 3)]
    changes = _changes(spark, rows)
    got = [(r.id, r.date_event) for r in timetravel.replay_after_rows(changes, 2, ids=["a", "b"]).collect()]
    assert got == [("b", 3), ("a", 5), ("a", 7)]


def test_latest_ties_and_last(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 3, "n"), ("c", None, "q")], "k string, d int, v string"
    )
    ties = sorted(tuple(r) for r in latest.latest_ties(df, "k", "d").collect())
    assert ties == [("a", 2, "y"), ("a", 2, "z")]
    last = sorted(tuple(r) for r in latest.latest_per_key(df.where("k is not null and d is not null"), "k", ["d", "v"]).collect())
    assert last == [("a", 2, "z")]


def test_replay_ids_as_frame(spark):
    rows = [("a", "A", 5, 0), ("b", "A", 3, 1), ("a", "B", 7, 2), ("c", "A", 9, 3)]
    changes = _changes(spark, rows)
    ids = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    got = [(r.id, r.date_event) for r in timetravel.replay_after_rows(changes, 2, ids=ids).collect()]
    assert got == [("b", 3), ("a", 5), ("a", 7)]
    table = hist.history_table(changes)
    assert sorted((r.id, r.date_event) for r in timetravel.replay_after(table, 2, ids=ids).collect()) == sorted(got)


def test_null_places_stay_in_their_positions(spark):
    rows = [("a", "A", 1, 0), ("a", "B", 2, 1), ("a", "C", 3, 2)]
    events = make_events(spark, rows).withColumn("location", F.when(F.col("seq") > 0, F.col("location")))
    changes = tr.transitions(events, num_partitions=2)
    last = hist.history_rows(changes).orderBy("seq").collect()[-1]
    assert last.location_memory == [None, "loc-1", "loc-2"]
    for table in (hist.history_table(changes), hist.history_table(changes, segment_size=2)):
        assert timetravel.asof_snapshot(table, 2).first().location == "loc-1"
        assert [r.location for r in timetravel.replay_after(table, 1).collect()] == ["loc-1", "loc-2"]


def test_segments_do_not_depend_on_the_layout(spark):
    rnd = random.Random(13)
    rows = [(rnd.choice(["hot", "hot", "k1", "k2"]), rnd.choice("ABC"), s // 3, s) for s in range(500)]
    tables = []
    for parts in (1, 4, 9):
        table = hist.history_table(_changes(spark, rows, parts), segment_size=30)
        tables.append(sorted(map(str, table.collect())))
    assert tables[0] == tables[1] == tables[2] and len(tables[0]) > 3


def test_latest_ties_keeps_ties_and_drops_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n"), ("b", None, "m"), ("c", 1, "w"), ("c", 1, "w")],
        "k string, d long, v string",
    )
    got = sorted((r.k, r.v) for r in latest.latest_ties(df, "k", "d").collect())
    assert got == [("a", "y"), ("a", "z"), ("c", "w"), ("c", "w")]

"""Distributed transition filter vs the plain sequential rule."""

import random

import pytest
from conftest import make_events
from test_fold_kernels import HAND_CASES, parse_case

from eventide.operators import fold
from eventide.operators import transitions as tr


def _expected(rows):
    by_key = {}
    for k, t, d, s in sorted(rows, key=lambda r: (r[0], r[3])):
        by_key.setdefault(k, []).append((t, d, s))
    acc, late = set(), set()
    for k, evs in by_key.items():
        dec = fold.fold_reference([(t, d) for t, d, _ in evs])
        for (t, d, s), x in zip(evs, dec):
            if x == fold.ACCEPTED:
                acc.add((k, s))
            elif x == fold.LATE:
                late.add((k, s))
    return acc, late


def _got(spark, rows, parts):
    ann = tr.annotate_transitions(make_events(spark, rows), num_partitions=parts)
    res = ann.select("id", "seq", "accepted", "late", "_pid", "_chunk").collect()
    acc = {(r.id, r.seq) for r in res if r.accepted}
    late = {(r.id, r.seq) for r in res if r.late}
    return acc, late, res


@pytest.mark.parametrize("parts", [1, 3])
def test_hand_cases(spark, parts):
    rows = []
    for case_no, (arrivals, _) in enumerate(HAND_CASES):
        for pos, (t, d) in enumerate(parse_case(arrivals)):
            rows.append((f"k{case_no}", t, d, pos))
    acc, _, _ = _got(spark, rows, parts)
    for case_no, (arrivals, accepted) in enumerate(HAND_CASES):
        evs = parse_case(arrivals)
        got = [evs[pos] for pos in range(len(evs)) if (f"k{case_no}", pos) in acc]
        assert got == parse_case(accepted), arrivals


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_skewed_key_split_across_partitions(spark, seed):
    """One key holds about a third of the rows and spans several partitions; the
    result still equals the sequential fold of every key."""
    rnd = random.Random(seed)
    rows = []
    seq = 0
    for _ in range(900):
        k = "hot" if rnd.random() < 0.34 else f"k{rnd.randint(0, 40)}"
        rows.append((k, rnd.choice("ABC"), rnd.randint(0, 60), seq))
        seq += 1
    rnd.shuffle(rows)
    acc, late, res = _got(spark, rows, 7)
    want_acc, want_late = _expected(rows)
    assert acc == want_acc
    assert late == want_late
    hot_parts = {r._pid for r in res if r.id == "hot"}
    assert len(hot_parts) > 1


def test_sorted_dates_use_lag_form_equally(spark):
    rnd = random.Random(5)
    rows = []
    for s in range(600):
        rows.append((f"k{rnd.randint(0, 9)}", rnd.choice("AB"), s // 3, s))
    events = make_events(spark, rows)
    fold_rows = {tuple(r) for r in tr.transitions(events, num_partitions=5).select("id", "seq").collect()}
    lag_rows = {tuple(r) for r in tr.transitions_lag(events).select("id", "seq").collect()}
    assert fold_rows == lag_rows


def test_change_kind_and_previous_type(spark):
    rows = [("a", t, d, i) for i, (t, d) in enumerate(parse_case("A@1 A@2 B@3 B@4 A@5"))]
    out = tr.with_change_kind(tr.transitions(make_events(spark, rows), num_partitions=2))
    got = sorted((r.seq, r.change_kind, r.previous_type) for r in out.collect())
    assert got == [(0, "created", None), (2, "updated", "A"), (4, "updated", "B")]


def test_null_fields_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", "A", 1, 0), ("a", None, 2, 1), (None, "B", 3, 2), ("a", "B", None, 3), ("a", "B", 4, 4)],
        "id string, event_type string, date_event long, seq long",
    )
    got = sorted(r.seq for r in tr.transitions(df, num_partitions=2).collect())
    assert got == [0, 4]


def test_driver_table_counts(spark):
    from conftest import SF01

    from eventide.sources.events import events_from_table

    ordered = tr.annotate_transitions(events_from_table(spark, SF01))
    assert ordered.where("accepted").count() == 8016
    shuffled = tr.annotate_transitions(events_from_table(spark, SF01, "shuffled"))
    assert shuffled.where("accepted").count() == 713
    assert shuffled.where("late").count() == 7342


def test_settings_may_change_between_build_and_run(spark):
    """The lazy result reads the same chunks whatever the read settings are by then."""
    rnd = random.Random(9)
    rows = []
    for seq in range(3000):
        k = "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 20)}"
        rows.append((k, rnd.choice("ABC"), rnd.randint(0, 200), seq))
    ann = tr.annotate_transitions(make_events(spark, rows), num_partitions=5)
    settings = {
        "spark.sql.files.maxPartitionBytes": "4096",
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "50",
        "spark.sql.shuffle.partitions": "3",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        res = ann.select("id", "seq", "accepted", "late", "_chunk").collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want_acc, want_late = _expected(rows)
    assert {(r.id, r.seq) for r in res if r.accepted} == want_acc
    assert {(r.id, r.seq) for r in res if r.late} == want_late
    assert len({r._chunk for r in res}) == 5


@pytest.mark.parametrize("types", [["A"], ["A", "B"], [f"t{i}" for i in range(500)]])
def test_summaries_of_a_hot_key_are_bounded(spark, types):
    """One key of one type with rising dates has a piece per date; all but those that an
    entering date can reach are cut before they are gathered by key."""
    rnd = random.Random(3)
    rows = [("hot", rnd.choice(types), seq, seq) for seq in range(4000)]
    events = make_events(spark, rows).repartitionByRange(8, "id", "seq").sortWithinPartitions("id", "seq")
    events = events.withColumn(tr.PID, tr.F.spark_partition_id())
    summaries = events.select(tr.PID, "id", "event_type", "date_event").mapInArrow(
        tr._summarise("id", "event_type", "date_event"), tr._SUMMARY
    )
    sizes = [len(r.thr) for r in tr.bounded_summaries(summaries).collect() if r._role == 1]
    assert len(sizes) == 8 and max(sizes[1:]) <= 2
    acc, late, _ = _got(spark, rows, 8)
    want_acc, want_late = _expected(rows)
    assert acc == want_acc and late == want_late


def test_nothing_is_collected_to_the_driver():
    import inspect

    assert ".collect(" not in inspect.getsource(tr) and "broadcast(" not in inspect.getsource(tr)


def test_unicode_and_mixed_case_keys(spark):
    """Spark's string sort and the fold's order check agree on any keys."""
    rnd = random.Random(12)
    keys = ["é", "e", "E", "zz", "Z", "k10", "k9", "日本", "ü-1", ""]
    rows = [(rnd.choice(keys), rnd.choice("AB"), rnd.randint(0, 30), s) for s in range(500)]
    acc, late, _ = _got(spark, rows, 4)
    want_acc, want_late = _expected(rows)
    assert acc == want_acc and late == want_late


def test_null_order_is_left_out(spark):
    df = spark.createDataFrame([("a", "A", 1, 0), ("a", "B", 2, None), ("a", "B", 3, 2)],
                               "id string, event_type string, date_event long, seq long")
    assert sorted(r.seq for r in tr.transitions(df, num_partitions=2).collect()) == [0, 2]


@pytest.mark.parametrize("seed", [21, 22])
def test_initial_state_edges_across_many_ranges(spark, seed):
    """'-' types and negative dates (never accepted from the initial state) with
    keys cut into many small ranges: a key's early chunks may hold only rejected
    events, so the initial state has to travel across chunks intact."""
    rnd = random.Random(seed)
    rows = [(f"k{rnd.randint(0, 3)}", rnd.choice(["A", "B", "-", "-"]), rnd.randint(-6, 12), s) for s in range(700)]
    acc, late, _ = _got(spark, rows, 11)
    want_acc, want_late = _expected(rows)
    assert acc == want_acc and late == want_late


def test_large_arrow_string_types(spark):
    """The Arrow passes follow the session's Arrow string type."""
    rows = [(f"k{i % 5}", "AB"[i % 3 % 2], i // 4, i) for i in range(200)]
    key = "spark.sql.execution.arrow.useLargeVarTypes"
    old = spark.conf.get(key, "false")
    try:
        spark.conf.set(key, "true")
        acc, late, _ = _got(spark, rows, 3)
    finally:
        spark.conf.set(key, old)
    want_acc, want_late = _expected(rows)
    assert acc == want_acc and late == want_late


@pytest.mark.parametrize("ordered", [True, False])
def test_one_key_over_ten_thousand_chunks(spark, ordered):
    """The scan over a key's chunks: every entering state, and no group of more than
    sqrt(chunks) summaries."""
    import numpy as np
    import pandas as pd

    chunks, each = 10_000, 4
    rnd = random.Random(int(ordered))
    dates = [rnd.randint(0, 100_000) for _ in range(chunks * each)]
    dates = sorted(dates) if ordered else dates
    types = [rnd.choice("ABC") for _ in dates]
    rows, want, state = [], {}, (*tr._INIT, 0)
    for pid in range(chunks):
        part = slice(pid * each, (pid + 1) * each)
        t, d = np.array(types[part], dtype=object), np.array(dates[part])
        want[pid] = state
        dec, *_, after = fold.fold_segment(t, d, state[:3])
        state = (*after, state[3] + list(dec).count(fold.ACCEPTED))
        pieces = fold.run_pieces(t, d)
        rows.append((pid, "hot", 0, None, *[None] * len(pieces)))
        rows.append((pid, "hot", 1, int(d.max()), *map(list, pieces)))
    summaries = spark.createDataFrame(pd.DataFrame(rows, columns=tr._SUMMARY.names), tr._SUMMARY).checkpoint()
    got = {r[0]: (r[1], r[2], r[3], r[4]) for r in tr.entering_states(summaries, chunks).collect()}
    assert got == want
    blocks = tr.bounded_summaries(summaries, 100).groupBy("_k", tr.BLOCK).count()
    assert blocks.agg({"count": "max"}).first()[0] <= 100 and blocks.count() <= 100


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_changes_are_numbered_over_the_whole_key(spark, monkeypatch, limit):
    """``change_no`` needs no further pass, whether the states are broadcast or joined."""
    monkeypatch.setattr(tr, "BROADCAST_CHUNKS", limit)
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 9)}", rnd.choice("ABC"), rnd.randint(0, 90), s) for s in range(800)]
    out = tr.transitions(make_events(spark, rows), num_partitions=9)
    hinted = "strategy=broadcast" in out._jdf.queryExecution().toString()
    assert hinted == (limit > 0)
    by = {}
    for r in sorted(out.select("id", "seq", "change_no").collect(), key=lambda r: r.seq):
        assert r.change_no == len(by.setdefault(r.id, []))
        by[r.id].append(r.seq)
    acc, _ = _expected(rows)
    assert {(k, s) for k, v in by.items() for s in v} == acc

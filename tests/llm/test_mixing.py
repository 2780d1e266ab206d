"""Mixing: targets by resharing, words near the targets, repeats, reruns."""

import re

import pytest

from eventide.llm.mixing import mix, targets

SCHEMA = "doc_id long, text string, source string, size string, target string"


def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    total, target, fixed = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[n] for n in fixed)
        free = [n for n in names if n not in fixed]
        w = sum(weight[n] for n in free)
        target = {n: 3 * sizes[n] if n in fixed else rest * weight[n] / w for n in names}
        above = {n for n in free if target[n] > 3 * sizes[n]}
        if not above:
            return target
        fixed |= above


def rows(n=600):
    out = []
    for i in range(n):
        source = ["a", "b", "é", None, "tiny", "Z"][0 if i % 3 == 0 else i % 6]
        words = 0 if source == "tiny" and i > 60 else (i * 7) % 90
        out.append((i, " ".join(["w"] * words) + "\n\x0b", source, "x", "y"))
    return out + [(5, "same row", "a", "x", "y")] * 3 + [(None, "no id here", "b", "x", "y"), (77, None, None, "", "")]


def test_mix(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    got = mix(df).collect()
    size = {}
    for _, t, s, *_ in data:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = brute_targets(size)
    assert len(got) == len(data)
    taken = {}
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == size[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.02 * t, 4 * 32), (s, taken[s], t)
    again = mix(df.repartition(7, "text")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_single_source_takes_all_once(spark):
    df = spark.createDataFrame([(i, "a b c", None, "", "") for i in range(50)], SCHEMA)
    got = mix(df).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(3, 150, 150.0, 3)] * 50


@pytest.mark.parametrize("data", [[], [(1, None, "a", "", ""), (2, " ", None, "", "")]])
def test_nothing_to_mix(spark, data):
    got = mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert [(r.doc_id, r.size, r.target, r.taken) for r in sorted(got)] == [(d[0], 0, 0.0, 0) for d in data]


def test_targets_when_caps_bind_in_turn(spark):
    sizes = {"a": 1000, "b": 10, "c": 100, "d": 0, "e": 300}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))

"""Links of near copies: every pair is looked at, whichever of equal lists is kept."""

import os
import random

import numpy as np
from pyspark.sql import functions as F
from test_neardup import brute

from eventide.llm import neardup
from eventide.llm.common import scratch, scratch_scope, written
from eventide.llm.links import linked_groups


def test_equal_lists_keep_the_first_by_rank(spark):
    """Keys 10 and 20 have the same members; 20 has the lower rank, and is where pairs are formed."""
    members = [(node, 9 if node == 3 else 1) for node in (1, 2, 3)]
    rows = [(key, node, float(central), rank) for key, rank in ((10, 4), (20, 3)) for node, central in members]
    entries = spark.createDataFrame(rows, "key long, node long, central double, rank long")
    nodes = spark.createDataFrame([(n, 20) for n in (1, 2, 3)], "node long, first long")

    def verify(pairs):
        return pairs.where("a = 1 AND b = 2")  # nothing is near the hub, 3

    got = linked_groups(entries, verify, nodes=nodes, condition=lambda a, b: F.col("a.first") == a("key"))
    assert {(r.node, r.component) for r in got.collect()} == {(1, 1), (2, 1)}


def test_tables_go_when_nothing_reads_them(spark):
    """Those of a check with its end, those of lists before the second check."""
    rows = [(key, node, 1.0 + (node == 3)) for key in (1, 2) for node in range(1, 4 + key)]
    entries = spark.createDataFrame(rows, "key long, node long, central double")
    seen = []

    def tables():
        return set(os.listdir(scratch(spark).removeprefix("file:")))

    def verify(pairs):
        mine = written(pairs, "mine")
        seen.append({name.rsplit("-", 1)[0] for name in tables() - before})
        return mine.where("a = 1 AND b = 2")

    written(entries, "other")  # makes the folder
    before = tables()
    with scratch_scope(spark):
        got = linked_groups(entries, verify)
        assert {(r.node, r.component) for r in got.collect()} == {(1, 1), (2, 1)}
        assert {name.rsplit("-", 1)[0] for name in tables() - before} == {"groups"}
    assert seen == [{"members", "hub-pairs", "mine"}, {"rest-pairs", "mine"}]


def test_small_groups_of_edited_copies_equal_all_pairs(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for g in range(150):
        vocabulary = [f"g{g}w{j}" for j in range(500)]
        base, own = rng.choices(vocabulary, k=rng.choice((40, 80, 160))), []
        for _ in range(rng.randint(3, 25)):
            words = list(base)
            for _ in range(rng.randint(0, len(base) // 14)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            own.append((len(rows) + len(own), " ".join(words)))
        want |= {i: c for (i, _), (_, c) in zip(own, brute(own, 4), strict=True)}
        rows += own
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, ngram=4).collect()} == want


def test_parities_bound_the_unequal_shingles():
    rng = np.random.default_rng(4)
    for n in (0, 1, 150, 5000):
        whole = np.unique(rng.integers(0, 1 << 63, n + 40, np.int64))
        x, y = whole[: len(whole) - 20], whole[20:]
        bits = sum(int(v).bit_count() for v in (neardup.parities(x) ^ neardup.parities(y)).view(np.uint64))
        assert bits <= len(np.setxor1d(x, y)) == 40 and bits % 2 == 0
        assert bits >= 30


def test_copies_just_below_the_similarity_form_no_pairs(spark, monkeypatch):
    """A group of copies with similarities of 0.6 to 0.8 to nearly all others: its pairs are not formed for nothing."""
    rng, formed = random.Random(6), []
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(150), rng.choice((1, 4, 5, 6))):
            words[at] = f"e{i}x{at}"
        rows.append((i, " ".join(words)))

    def counted(entries, verify, **kinds):
        def check(pairs):
            formed.append(pairs.count())
            return verify(pairs)

        return linked_groups(entries, check, **kinds)

    monkeypatch.setattr(neardup, "linked_groups", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, ngram=4).collect()}
    assert got == {i: c for (i, _), (_, c) in zip(rows, brute(rows, 4), strict=True)}
    assert 100 < len(set(got.values())) < 400 and sum(formed) < 10 * len(rows)

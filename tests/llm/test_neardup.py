"""Components, and near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from eventide.llm import neardup
from eventide.llm.links import components


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def sets_of(text, n):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def brute(rows, n, percent=80):
    """(size, component) of each row; links between rows, components by ids."""
    sets = [sets_of(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    owners = {}
    for i, s in enumerate(sets):
        for x in s:
            owners.setdefault(x, []).append(i)
    near = {(a, b) for own in owners.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    for a, b in near:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = [None] * len(rows)
    for members in groups.values():
        low = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        for i in members:
            out[i] = (len(sets[i]), low)
    return out


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (500, 400)]
    edges += [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def fixture():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(4000)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    rows, i = [], 0
    base, common = prose(220), prose(70)
    for k in range(45):  # a group of near copies: each a few words from its base
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 4, 9))):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i := i + 1, " ".join(w)))
    for k in range(60):  # unlike documents around one passage
        rows.append((i := i + 1, " ".join(prose(rng.choice((10, 20, 40, 200))) + common + prose(10))))
    rows += [(i := i + 1, " ".join(base).upper()) for _ in range(5)]
    chain = prose(120)
    for k in range(12):  # a chain: neighbours are near, ends are not
        rows.append((i := i + 1, " ".join(chain[k * 6 :] + [f"c{j}" for j in range(k * 6)])))
    rows += [(i := i + 1, t) for t in (None, "", " \n\t", "one", "One", "a b c", "A  b\nc", "a b c d", "a b c d e", "Ä b c", "ä b c")]
    rows += [(i := i + 1, "x y z " * 5000), (i := i + 1, "x y z " * 4000), (3, rows[2][1]), (None, rows[0][1]), (None, "no id at all here")]
    return rows


@pytest.mark.parametrize("ngram", [4, 5])
def test_groups_equal_all_pairs(spark, ngram):
    rows = fixture()
    df = spark.createDataFrame([(a, t, "clash", "clash") for a, t in rows], "doc_id long, text string, node string, n_shingles string")
    got = neardup.near_duplicates(df, ngram=ngram).collect()
    want = brute(rows, ngram)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        (str(a), n, str(c)) for (a, _), (n, c) in zip(rows, want, strict=True)
    )
    assert all(r.kept == (r.doc_id == r.component_id if r.doc_id is not None else r.component_id is None) for r in got)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_whole_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, ngram=4).collect()}
    assert got == {a: w for (a, _), w in zip(rows, brute(rows, 4), strict=True)}


def test_hashes_do_not_depend_on_slices():
    rng = random.Random(6)
    texts = ["".join(rng.choice("aB cé\n\x0b🙂") for _ in range(rng.randint(0, 90))).encode() for _ in range(50)]
    one = [list(s) for s in neardup.batch_sets(texts, 4)]
    assert one == [list(s) for s in neardup.batch_sets(texts, 4, slice_bytes=11)]
    assert [len(s) for s in one] == [len(sets_of(t.decode(), 4)) for t in texts]
    assert all((np.diff(s) > 0).all() and (np.array(s) >= 0).all() for s in one)

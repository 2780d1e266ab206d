"""The join against all pairs, and the trie against plain sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from tests.conftest import SF01

from eventide.llm import prefixjoin
from eventide.llm.catalogue import op13_prefixjoin

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    return {tuple(words[i : i + min(n, len(words))]) for i in range(max(len(words) - n, 0) + 1)} if words else set()


def brute(rows):
    """All pairs that share a shingle, counted in full."""
    found = [(i, shingles(t)) for i, t in rows]
    holders = defaultdict(list)
    for k, (_, s) in enumerate(found):
        for x in s:
            holders[x].append(k)
    up = list(range(len(found)))

    def top(k):
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for k, (_, s) in enumerate(found):
        both = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < k:
                    both[j] += 1
        for j, c in both.items():
            if 100 * c >= 80 * (len(s) + len(found[j][1]) - c):
                up[top(k)] = top(j)
    least = {}
    for k, (i, _) in enumerate(found):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(((i, len(s), least.get(top(k))) for k, (i, s) in enumerate(found)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(op13_prefixjoin(spark, SF01))
    assert got == brute(rows)
    assert sum(i != c for i, _, c in got) > 20


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.choice([0, 1])] = [rng.choice("abcdefghij") * 3] if rng.random() < 0.7 else []
        words = words or ["x"]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_groups(spark, seed):
    """Groups of copies with a few edits each, so that many similarities are near the limit;
    NULLs, short, empty and long texts, repeated rows, a passage that many share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    rows, at = [], 0
    for _ in range(40):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 12, 30, 60, 150]))]
        if rng.random() < 0.5:
            base[2:2] = passage
        for _ in range(rng.choice([1, 2, 5, 12])):
            rows.append((at, " ".join(edited(rng, base, rng.randrange(4)))))
            at += 1
    rows += [(at, None), (at + 1, ""), (at + 2, " \n"), (at + 3, "One two"), (at + 4, "oNE\ttwo"), rows[0], (rows[1][0], "other text")]
    rows += [(at + 5, " ".join(f"l{i}" for i in range(30_000))), (at + 6, " ".join(f"l{i}" for i in range(2_000, 31_000)))]
    rows += [(at + 7 + i, " ".join(passage)) for i in range(30)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS node", "2 AS id", "3 AS component")
    assert rows_of(prefixjoin.prefix_join(df)) == brute(rows)


def test_null_ids(spark):
    rows = [(None, "a b c d e f"), (3, "A b c d e f"), (None, "alone in this")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(prefixjoin.prefix_join(df)) == sorted([(None, 2, 3), (3, 2, 3), (None, 1, None)], key=str)


def test_empty(spark):
    assert prefixjoin.prefix_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_trie_equals_sets():
    rng = random.Random(5)
    base = list(range(60))
    stored = [sorted(rng.sample(base, rng.randrange(40, 60))) for _ in range(200)] + [[], base]
    trie = prefixjoin.SetTrie([np.array(s, np.int64) for s in stored], [len(s) + k % 3 for k, s in enumerate(stored)])
    for _ in range(20):
        probe = rng.sample(base, 52)
        want = [k for k, s in enumerate(stored) if 180 * len({*probe} & {*s}) >= 80 * (52 + len(s) + k % 3)]
        assert sorted(trie.similar(np.array(probe, np.int64), 52, 80)) == want
    assert trie.compared < 20 * sum(map(len, stored))

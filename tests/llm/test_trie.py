"""The trie against a plain one over nested sequences."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tests.conftest import SF01

from eventide.llm import trie
from eventide.llm.catalogue import op12_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in turns.items()}
    members, ends = {}, {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 4, c - c % 20 if c >= 0 else c + -c % 20
        seq = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for k in members:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    for k in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] = leaves.get(k[:d], 0) + (k not in kids)
            saved[k[:d]] = saved.get(k[:d], 0) + (len(members[k]) - 1) * words
    out = []
    for k, m in members.items():
        hashed = hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k], hashed))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op12_trie(spark, SF01)) == brute(rows)


@pytest.mark.parametrize("upper", [2, 5, 1 << 16])
def test_shared_prefixes(spark, monkeypatch, upper):
    """Few texts, so that many prefixes meet; upper tries of several depths; NULLs, odd ids."""
    monkeypatch.setattr(trie, "UPPER", upper)
    rng = random.Random(upper)
    rows = []
    for c in [*range(-25, 90), 200, 201, 219]:
        rows += [(c, t, rng.choice(["user", None]), rng.choice(["a b", "a  b\tc", "", None])) for t in range(rng.choice([1, 1, 2, 3, 7]))]
    rows += [(300 + c, t, "user", f"same {t}") for c in range(40) for t in range(4)]
    rows += [(400, None, "user", "first"), (400, -1, "user", "x " * 50_000), (None, 0, "user", "no one's")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "'x' AS digest", "2 AS words", "3 AS depth")
    assert rows_of(trie.rebuilt_trie(df)) == brute(rows)


def test_repeated_turns_are_steps(spark):
    rows = [(0, 0, "user", "a"), (0, 0, "user", "a"), (0, 1, None, None)]
    assert rows_of(trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty(spark):
    assert trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(2**62), 2**62, (2, 50_000))
    table = trie.PerfectHash(hi, lo)
    assert sorted(table.slots) == list(range(len(hi)))
    assert (table.lookup(hi, lo) == table.slots).all()
    assert (table.lookup(hi, lo + 1) == -1).all()
    with pytest.raises(ValueError):
        trie.PerfectHash(np.r_[hi, hi[:1]], np.r_[lo, lo[:1]])

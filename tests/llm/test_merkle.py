"""The manifest against a plain tree, small blocks included."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from tests.conftest import SF01

from eventide.llm import merkle
from eventide.llm.catalogue import op11_merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        low = out[-1]
        out.append([h(*low[i : i + 2]) for i in range(0, len(low), 2)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        run = level[i & ~1 : (i & ~1) + 2]
        out.append((i & 1, [d for k, d in enumerate(run) if k != (i & 1)]))
        i >>= 1
    return out


def climb(value, steps):
    for at, others in steps:
        value = h(*others[:at], value, *others[at:])
    return value


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf(r) for r in sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for i, r in enumerate(sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            steps = path(trees[g], i) + path(top, at)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            start = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            end = climb(start, steps)
            proof = h(*(d for _, others in steps for d in others))
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *map(str, r[1:]))


def rows_of(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=key)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = rows_of(op11_merkle(spark, SF01))
    assert got == sorted(brute(rows), key=key)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 37])
def test_small_blocks(spark, n):
    """Several tiers of blocks of 4; NULLs in every column, repeated rows, a NULL group."""
    rows = [(i, None if i % 5 == 0 else "s", None if i % 3 == 0 else f"l{i % 2}é", None if i % 4 == 0 else i, None if i % 6 == 0 else "té\n" * i) for i in range(n)]
    rows += [rows[-1], (None, None, None, None, None), (7, "s", "l1é", 7, ""), (14, None, "z", 0, "x" * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit(1), "total": F.lit("x"), "grp": F.lit(2), "node": F.lit(0)})
    where = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    got = rows_of(merkle.manifest(df, {"n_chars": F.col("n_chars") + 1}, where=where, bits=2))
    assert got == sorted(brute(rows), key=key)


def test_empty(spark):
    assert merkle.tampered_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_versions_share_nodes():
    tree = merkle.Tree([h(str(i)) for i in range(9)], merkle.height(9))
    before = len(tree.digests)
    top = tree.version(5, h("new"))
    assert len(tree.digests) == before + 1 + merkle.height(9)
    shared, stack = set(), [top]
    while stack:
        node = stack.pop()
        shared.add(node)
        stack += tree.children[node]
    assert sum(node < before for node in shared) == len(shared) - 1 - merkle.height(9)
    assert tree.digests[tree.top] == levels([h(str(i)) for i in range(9)])[-1][0]

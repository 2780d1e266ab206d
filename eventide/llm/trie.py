"""Prefix trie of conversations, its nodes in minimal-perfect-hash tables.

1. Turns are reduced to a digest and a word count in the JVM; texts go no further.
2. Prefix digests.  A conversation's turns, in order, pass through one task as a stream: the
   digest of a prefix is the hash of the shorter prefix's digest and the turn's.
3. Equal prefixes are counted (combined before the shuffle, so that a first turn of very many
   conversations is one row a task).
4. Shards.  Nodes of more than ``T`` conversations are the upper trie; ``T`` is set so that it
   has 2^20 nodes at most.  Each subtree below it is in one shard, by the digest of its
   topmost node; shards hold many small subtrees.
5. In a shard, the distinct digests get the slots of a minimal perfect hash.  The key in each
   slot is kept and compared, so that a digest never reads another's slot.  Counts are
   scattered into flat arrays, and leaves and saved tokens are added up through the array of
   parent slots, deepest nodes first.
6. What a shard's topmost nodes add up to is summed by their parents, and the upper trie is
   accumulated in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import CRC32, WORD, written
from eventide.session import partitions_for, ship_package

#: A node of more conversations than this, or than a 2^20th of all prefixes, is in the upper trie.
UPPER, UPPER_BITS = 1 << 16, 20
#: Nodes in a shard, besides its last subtree.
SHARD_NODES = 1 << 18
#: Levels of a perfect hash; distinct keys need about a dozen.
MOST_LEVELS = 96

ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
PATHS = "conv long, depth long, hi long, lo long, p_hi long, p_lo long, words long, last boolean"
NODES = "hi long, lo long, p_hi long, p_lo long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Slots 0..n-1 for n distinct 128-bit keys.

    A level is a table of twice as many places as keys; a key that is alone in its place has
    found its slot, the place's rank, and the others go on to the next level."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.slots = np.full(len(hi), -1, np.int64)
        left, given = np.arange(len(hi)), 0
        while len(left):
            if len(self.levels) == MOST_LEVELS:
                raise ValueError("a digest occurs twice")
            places = self._places(hi[left], lo[left], len(self.levels), 2 * len(left))
            alone = np.bincount(places, minlength=2 * len(left)) == 1
            ranks = np.cumsum(alone) - 1 + given
            self.levels.append((alone, ranks))
            found = alone[places]
            self.slots[left[found]] = ranks[places[found]]
            given += int(alone.sum())
            left = left[~found]
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        self.hi[self.slots], self.lo[self.slots] = hi, lo

    @staticmethod
    def _places(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        h = _mix(hi.view(np.uint64) + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) ^ lo.view(np.uint64)
        return (_mix(h) % np.uint64(size)).astype(np.int64)

    def lookup(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where the slot's key is another."""
        out, left = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for level, (alone, ranks) in enumerate(self.levels):
            places = self._places(hi[left], lo[left], level, len(alone))
            found = alone[places]
            out[left[found]] = ranks[places[found]]
            left = left[~found]
        there = out >= 0
        there[there] = (self.hi[out[there]] == hi[there]) & (self.lo[out[there]] == lo[there])
        return np.where(there, out, -1)


def accumulate(nodes: pa.Table) -> pa.Table:
    """The ``NODES`` of one shard from its counted prefixes.  ``more_*``: what nodes of other
    shards below a node add to it."""
    get = lambda name: nodes[name].to_numpy()
    table = PerfectHash(get("hi"), get("lo"))
    parent = np.empty(len(table.slots), np.int64)
    parent[table.slots] = table.lookup(get("p_hi"), get("p_lo"))

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.empty(len(values), np.int64)
        out[table.slots] = values
        return out

    depth, convs, conv = (scattered(get(c)) for c in ("depth", "n_convs", "conv_id"))
    parent[depth == 0] = -1
    inside = parent >= 0
    children = scattered(get("more_children"))
    np.add.at(children, parent[inside], 1)
    leaves = scattered(get("more_leaves")) + (children == 0)
    saved = scattered(get("more_saved")) + (convs - 1) * scattered(get("words"))
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[inside[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    out = {
        "hi": table.hi, "lo": table.lo, "p_hi": scattered(get("p_hi")), "p_lo": scattered(get("p_lo")), "conv_id": conv, "depth": depth,
        "parent_conv_id": pa.array(conv[parent], mask=~inside), "n_convs": convs, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
    }
    return pa.table(out)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``PATHS`` of (conv, digest, words) in order; a row without a digest begins a conversation."""
    names = [f.split()[0] for f in PATHS.split(", ")]
    held: tuple | None = None  # the last prefix, until it is known whether it is its conversation's last

    def made(rows: list[tuple]) -> pa.RecordBatch:
        conv, depth, node, parent, words, last = zip(*rows, strict=True)
        halves = [np.frombuffer(b"".join(x), ">i8").astype(np.int64).reshape(-1, 2) for x in (node, parent)]
        columns = [conv, depth, *(h[:, i] for h in halves for i in (0, 1)), words, last]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    for batch in batches:
        rows = []
        for conv, turn, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held is not None:
                rows.append((*held, turn is None))
            if turn is None:
                held = (conv, 0, ROOT, ROOT, 0)
            else:
                _, depth, node, _, _ = held
                held = (conv, depth + 1, hashlib.sha256(node + turn).digest()[:16], node, words)
        if rows:
            yield made(rows)
    if held is not None:
        yield made([(*held, True)])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hi, lo, ends_sha256`` of (hi, lo, conv) in order: each node's conversations as a stream."""
    now, state = None, None
    for batch in batches:
        rows = []
        for hi, lo, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (hi, lo) != now:
                if now is not None:
                    rows.append((*now, state.hexdigest()))
                now, state = (hi, lo), hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["hi", "lo", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())], names=["hi", "lo", "ends_sha256"])


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, place, digest, words`` of each turn: ``place`` from 0 in the order of ``turn_col``
    (NULL first, ties by digest).  NULL role or text is empty; rows without an id are no turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv", (F.row_number().over(order) - 1).cast("long").alias("place"), "digest", "words")


def rebuilt(turns: DataFrame, first: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) where each ``conv`` begins with the first ``first`` turns of the
    conversation ``base`` and goes on with its own turns after its first ``first``.

    ``first`` (a small bound) and ``base`` are expressions of ``conv``."""
    turns = written(turns, "turns")
    convs = written(turns.select("conv").distinct().withColumns({"first": first, "base": base}), "convs")
    lead = turns.select(F.col("conv").alias("base"), "place", "digest", "words")
    lead = convs.join(lead, "base").where("place < first").select("conv", F.lit(0).alias("part"), "place", "digest", "words")
    own = turns.where(F.col("place") >= first).select("conv", F.lit(1).alias("part"), "place", "digest", "words")
    return convs.select("conv"), lead.union(own)


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, the root (no turn) included: ``conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``convs``: ``conv``, a row for each conversation, without turns too.  ``turns``: ``conv,
    part, place, digest, words``, in the order of (part, place).  ``conv_id`` is a node's
    smallest conversation; ``n_leaves`` and ``saved_tokens`` (words of the last turn, times
    conversations less one) are sums over the subtree, the node included; ``ends_sha256`` hashes
    the ids of the conversations that end there, ascending, comma-joined.

    A conversation is a unit: its turns go through one task, as a stream, and so do the ids of
    one node for their hash.  Equal turns in one conversation are steps of their own.  No
    conversations: no rows.
    """
    spark = convs.sparkSession
    ship_package(spark)
    heads = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    rows = written(heads.union(turns), "sequences")
    rows = rows.repartition(partitions_for(rows), "conv").sortWithinPartitions("conv", "part", "place")
    paths = written(rows.select("conv", "digest", "words").mapInArrow(_chains, PATHS), "paths")

    same = [F.min(c).alias(c) for c in ("depth", "p_hi", "p_lo", "words")]
    nodes = written(paths.groupBy("hi", "lo").agg(*same, F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")), "prefixes")
    totals = nodes.agg(F.count("*").alias("nodes"), F.sum("n_convs").alias("rows")).first()
    if not totals.nodes:
        return spark.createDataFrame([], NODES).drop("hi", "lo", "p_hi", "p_lo").withColumn("ends_sha256", F.lit(NO_ENDS))
    most = max(UPPER, totals.rows >> UPPER_BITS)
    is_upper = (F.col("n_convs") > most) | (F.col("depth") == 0)
    upper = written(nodes.where(is_upper), "upper")  # 2^20 nodes at most, and the root

    marks = F.broadcast(upper.select("hi", "lo"))
    above = paths.join(marks, ["hi", "lo"], "left_semi").groupBy("conv").agg(F.max("depth").alias("above"))
    tops = paths.join(above, "conv").where(F.col("depth") == F.col("above") + 1)
    tops = written(tops.select(F.col("conv").alias("conv_id"), F.xxhash64("hi", "lo").alias("top")), "tops")
    shards = max(spark.sparkContext.defaultParallelism, -(-totals.nodes // SHARD_NODES))
    none = {c: F.lit(0).cast("long") for c in ("more_children", "more_leaves", "more_saved")}
    low = nodes.where(~is_upper).join(tops, "conv_id").withColumns(none)
    low = low.withColumn("shard", F.pmod("top", F.lit(shards))).drop("top")
    low = written(low.groupBy("shard").applyInArrow(accumulate, NODES), "shards")

    below = low.where("parent_conv_id IS NULL").groupBy(F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo")).agg(
        F.count("*").alias("more_children"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
    )
    high = upper.join(below, ["hi", "lo"], "left").fillna(0, list(none))
    high = written(high.withColumn("shard", F.lit(0)).groupBy("shard").applyInArrow(accumulate, NODES), "upper-trie")

    ends = paths.where("last").select("hi", "lo", "conv")
    ends = ends.repartition(partitions_for(ends), "hi", "lo").sortWithinPartitions("hi", "lo", "conv")
    ends = written(ends.mapInArrow(_ends, "hi long, lo long, ends_sha256 string"), "ends")
    parents = F.broadcast(upper.select(F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("conv_id").alias("_parent")))
    low = low.join(parents, ["p_hi", "p_lo"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent")).select(high.columns)
    names = [c for c in high.columns if c not in ("hi", "lo", "p_hi", "p_lo")]
    return low.union(high).join(ends, ["hi", "lo"], "left").select(*names, F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, *, family: int = 20, spread: int = 4, **columns: str) -> DataFrame:
    """The trie of ``conversations`` of which each starts like the first of its ``family``, for
    0 to ``spread - 1`` turns by the CRC-32 of its id.  See ``turns_of``, ``rebuilt`` and
    ``prefix_trie``; other columns are not read."""
    first = F.crc32(F.col("conv").cast("string")) % spread
    base = F.col("conv") - F.col("conv") % family
    return prefix_trie(*rebuilt(turns_of(conversations, **columns), first, base))


def oracle() -> str:
    return rf"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p,
         coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (SELECT c, {CRC32.format("c")} % 4 AS h, c - c % 20 AS b FROM (SELECT DISTINCT c FROM t)),
seq AS (
  SELECT heads.c, 0 AS part, p, r, x FROM heads JOIN t ON t.c = b AND p < h
  UNION ALL SELECT t.c, 1, p, r, x FROM t JOIN heads ON heads.c = t.c WHERE p >= h),
ordered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, sha256(strlen(r) || ':' || r || x) AS g,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w
  FROM seq),
paths AS (
  SELECT c, d, string_agg(g, ',') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS k, w FROM ordered
  UNION ALL SELECT c, 0, '', 0 FROM heads),
ended AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS last FROM paths),
nodes AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n, any_value(w) AS w,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '')) AS ends
  FROM ended GROUP BY d, k),
linked AS (
  SELECT nodes.*, up.k AS pk FROM nodes LEFT JOIN paths up ON up.c = nodes.conv_id AND up.d = nodes.d - 1),
kids AS (SELECT pk AS k, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
counted AS (
  SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN kids ON kids.k = linked.k AND kids.d = linked.d),
sums AS (
  SELECT up.d, up.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n - 1) * counted.w) AS saved
  FROM counted JOIN paths up ON up.c = counted.conv_id AND up.d <= counted.d GROUP BY up.d, up.k)
SELECT me.conv_id, me.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, me.n AS n_convs,
       me.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, me.ends AS ends_sha256
FROM counted me JOIN sums ON sums.d = me.d AND sums.k = me.k
LEFT JOIN nodes parent ON parent.d = me.d - 1 AND parent.k = me.pk
"""

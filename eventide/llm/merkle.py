"""Merkle manifest of a dataset as a persistent tree with path copying.

1. Leaves.  A SHA-256 over the length-prefixed fields of each row, in the JVM; the texts are
   read once and go no further.
2. Positions within each group (``ranks.positions``); a group spans as many tasks as needed.
3. Aligned blocks.  ``2 ** BLOCK`` leaves that begin at a multiple of it are a complete subtree,
   whatever stands beside them.  A task builds a block's nodes; each tampered leaf makes a
   *version* of the block: only the leaf's ancestors are copied, and the copies point at the
   untouched nodes, which all versions share.
4. Upper levels.  The blocks' tops are the leaves of the next tier, again in aligned blocks,
   until a node is left for each group; the groups' tops are the leaves of the last tree.
   A block gets the path from its top to the root, and each version goes on along that path,
   again by copies of ancestors only, in the tasks that hold the versions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import CRC32, written
from eventide.llm.ranks import positions
from eventide.session import ship_package

#: Levels in an aligned block.
BLOCK = 11
#: Every node but a last one has two children.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value behind its length in bytes, or ``-``: no two rows have the same concatenation."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Tree:
    """A persistent tree: nodes are only ever added, so that every version's stay valid.

    Node ``i`` has ``digests[i]`` and ``children[i]`` (node numbers).  ``levels[l]`` are the
    nodes of the first version; a level holds half of the one below, rounded up.
    """

    def __init__(self, leaves: list[str], height: int) -> None:
        self.digests, self.children = list(leaves), [()] * len(leaves)
        self.levels = [list(range(len(leaves)))]
        for _ in range(height):
            low = self.levels[-1]
            self.levels.append([self._node(low[i : i + 2]) for i in range(0, len(low), 2)])

    def _node(self, children: list[int]) -> int:
        self.digests.append(digest(*[self.digests[c] for c in children]))
        self.children.append(tuple(children))
        return len(self.digests) - 1

    @property
    def top(self) -> int:
        return self.levels[-1][0]

    def siblings(self, leaf: int) -> list[tuple[str, str]]:
        """(side, digest) of each level's sibling; side ``-``: there is none."""
        out = []
        for level in self.levels[:-1]:
            other = leaf ^ 1
            out.append(("-", "") if other >= len(level) else ("L" if other < leaf else "R", self.digests[level[other]]))
            leaf >>= 1
        return out

    def version(self, leaf: int, value: str) -> int:
        """The top of the version whose leaf is ``value``: copies of its ancestors, all else shared."""
        self.digests.append(value)
        self.children.append(())
        node = len(self.digests) - 1
        for level in self.levels[:-1]:
            pair = level[leaf & ~1 : (leaf | 1) + 1]
            pair[leaf & 1] = node
            node = self._node(pair)
            leaf >>= 1
        return node


def fold(value: str, sides: str, siblings: bytes) -> str:
    """The digest at the end of a path from ``value``; ``siblings`` are raw digests in order."""
    at = 0
    for side in sides:
        if side == "-":
            value = digest(value)
            continue
        other = siblings[at : at + 32].hex()
        at += 32
        value = digest(other, value) if side == "L" else digest(value, other)
    return value


def height(total: int) -> int:
    """Levels above ``total`` leaves."""
    return (total - 1).bit_length()


def _blocks(bits: int) -> Callable[[pa.Table], pa.Table]:
    """The rows of an aligned block with ``sides``, ``siblings`` and ``top``, and ``folded``, the
    top of the row's version where ``changed`` is there, else of its own leaf and siblings."""

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        total = block["total"][0].as_py()
        tree = Tree(block["node"].to_pylist(), min(bits, height(total)))
        top = tree.digests[tree.top]
        sides, siblings, folded = [], [], []
        for i, (own, changed) in enumerate(zip(block["node"].to_pylist(), block["changed"].to_pylist(), strict=True)):
            path = tree.siblings(i)
            sides.append("".join(s for s, _ in path))
            siblings.append(bytes.fromhex("".join(d for _, d in path)))
            folded.append(fold(own, sides[-1], siblings[-1]) if changed is None else tree.digests[tree.version(i, changed)])
        for name, column in (("sides", sides), ("siblings", pa.array(siblings, pa.binary())), ("top", [top] * len(sides)), ("folded", folded)):
            block = block.append_column(name, column if isinstance(column, pa.Array) else pa.array(column, pa.string()))
        return block.drop_columns(["changed"])

    return run


def paths(nodes: DataFrame, most: int, bits: int) -> DataFrame:
    """``nodes`` (``grp, pos, total, node, changed`` and others) with ``block``, ``sides``,
    ``siblings``, ``top``, ``folded`` within the block and, above it, ``up_sides``,
    ``up_siblings`` and the group's ``summit``.  ``most``: the largest ``total``."""
    nodes = nodes.withColumn("block", F.shiftright("pos", bits))
    out = T.StructType([f for f in nodes.schema if f.name != "changed"]).add("sides", "string").add("siblings", "binary")
    out = out.add("top", "string").add("folded", "string")
    low = written(nodes.groupBy("grp", "block").applyInArrow(_blocks(bits), out), "blocks")
    if most <= 1 << bits:
        return low.select("*", F.lit("").alias("up_sides"), F.lit(b"").alias("up_siblings"), F.col("top").alias("summit"))
    size = 1 << bits
    tops = low.where(F.col("pos").bitwiseAND(F.lit(size - 1)) == 0).select(
        "grp", F.col("block").alias("pos"), F.shiftright(F.col("total") + (size - 1), bits).alias("total"), F.col("top").alias("node")
    )
    high = paths(tops.withColumn("changed", F.lit(None).cast("string")), -(-most >> bits) + 1, bits)
    high = written(
        high.select(
            F.col("grp").alias("_g"), F.col("pos").alias("_b"), F.concat("sides", "up_sides").alias("up_sides"),
            F.concat("siblings", "up_siblings").alias("up_siblings"), "summit",
        ),
        "upper-paths",
    )
    return low.join(high, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")


def _continued(rows: DataFrame) -> DataFrame:
    """``rows`` with ``folded_root``: each version taken on along its path to the root."""
    ship_package(rows.sparkSession)
    out = T.StructType([f for f in rows.schema if f.name not in ("folded", "all_sides")]).add("folded_root", "string")

    def run(batches):
        for batch in batches:
            known: dict[tuple, str] = {}
            tops = []
            for key in zip(*[batch[c].to_pylist() for c in ("folded", "up_sides", "up_siblings")], strict=True):
                if key not in known:
                    known[key] = fold(*key)
                tops.append(known[key])
            columns = [batch[f.name] for f in out if f.name != "folded_root"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tops, pa.string())], names=out.names)

    return rows.mapInArrow(run, out)


def manifest(
    docs: DataFrame,
    tampered: dict[str, Column] | None = None,
    *,
    where: Column | None = None,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    bits: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, leaf, subroot, root, proof_sha256, folded_root,
    verified, copied``.

    A leaf is the SHA-256 of the row's ``fields``; leaves of a group ascend by id.  Two
    consecutive nodes (a last one alone) become the SHA-256 of their hex digests until one is
    left, the ``subroot``; subroots in the order of the groups' UTF-8 bytes (NULL first) give
    ``root`` in the same way.  ``proof_sha256`` hashes the siblings from leaf to root.
    ``tampered`` has changed values of fields for the rows that ``where`` selects: such a
    row's version ends in ``folded_root``, and ``copied`` counts the nodes that it copied (0:
    the row is as it was).  Other rows are folded up from their own leaf and siblings.

    NULL fields count as ``-``; a NULL group is a group, a NULL id comes first in its group.
    Rows of one id are in the order of their leaves, so equal rows have equal leaves and a
    proof each.  A changed value that leaves the leaf as it is makes no version.  Empty or very
    long texts are hashed like any other.  Other columns are not read.  Empty input: empty output.
    """
    ship_package(docs.sparkSession)
    own = leaf_digest([F.col(f) for f in fields])
    changed = F.lit(None).cast("string")
    if tampered:
        changed = F.when(F.coalesce(where, F.lit(False)), leaf_digest([tampered.get(f, F.col(f)) for f in fields]))
    leaves = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), own.alias("node"), changed.alias("changed"))
    leaves = written(leaves.withColumn("changed", F.when(F.col("changed") != F.col("node"), F.col("changed"))), "leaves")
    placed = positions(leaves, "grp", ["id", "node"])
    most = placed.agg(F.max("total")).first()[0] or 0
    is_changed = F.col("changed").isNotNull()
    low = paths(placed.withColumn("copies", is_changed), most, bits)
    tops = written(low.where("pos = 0").select(F.col("grp").alias("own_grp"), F.col("summit").alias("node")), "subroots")
    tops = positions(tops.withColumn("grp", F.lit(0)), "grp", ["own_grp"])
    groups = tops.agg(F.max("total")).first()[0] or 0
    last = paths(tops.withColumn("changed", F.lit(None).cast("string")), groups, bits)
    last = written(
        last.select(
            "own_grp", F.concat("sides", "up_sides").alias("last_sides"), F.concat("siblings", "up_siblings").alias("last_siblings"),
            F.col("summit").alias("root"),
        ),
        "last-paths",
    )
    rows = low.join(last, F.col("grp").eqNullSafe(F.col("own_grp")))
    rows = rows.select(
        "id", F.col("node").alias("leaf"), F.col("summit").alias("subroot"), "root", "siblings", "copies", "sides",
        F.concat("up_sides", "last_sides").alias("up_sides"), F.concat("up_siblings", "last_siblings").alias("up_siblings"), "folded",
    )
    rows = _continued(rows)
    proof = F.sha2(F.lower(F.hex(F.concat("siblings", "up_siblings"))), 256)
    copied = F.when(F.col("copies"), F.length("sides") + F.length("up_sides") + 1).otherwise(0).cast("long")
    return rows.select(
        F.col("id").alias(id_col), "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), copied.alias("copied"),
    )


def tampered_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` with 1 added to ``n_chars`` where 7 divides the id's CRC-32."""
    where = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return manifest(docs, {"n_chars": F.col("n_chars") + 1}, where=where)


def oracle() -> str:
    def leaf(extra: int) -> str:
        values = [f"{c} + {extra}" if c == "n_chars" else c for c in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values) + ")"

    return f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {leaf(0)} AS leaf, CASE WHEN {CRC32.format("doc_id")} % 7 = 0 THEN {leaf(1)} END AS bad FROM documents)),
nodes AS (
  SELECT lang, 0 AS level, pos AS idx, leaf AS h, n FROM leaves
  UNION ALL
  SELECT lang, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2, n),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos AS idx, h, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, idx // 2, n),
climbing AS (
  SELECT doc_id, lang, pos, leaf, 0 AS level, pos AS idx, coalesce(bad, leaf) AS h, n, '' AS proof FROM leaves
  UNION ALL
  SELECT c.doc_id, c.lang, c.pos, c.leaf, c.level + 1, c.idx // 2,
         CASE WHEN s.h IS NULL THEN sha256(c.h) WHEN c.idx % 2 = 0 THEN sha256(c.h || s.h) ELSE sha256(s.h || c.h) END,
         (c.n + 1) // 2, c.proof || coalesce(s.h, '')
  FROM climbing c LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.idx = xor(c.idx, 1) WHERE c.n > 1),
half AS (
  SELECT c.doc_id, c.lang, c.leaf, c.h, c.proof, s.h AS subroot, s.pos, s.n
  FROM climbing c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1),
ending AS (
  SELECT doc_id, subroot, leaf, 0 AS level, pos AS idx, h, n, proof FROM half
  UNION ALL
  SELECT c.doc_id, c.subroot, c.leaf, c.level + 1, c.idx // 2,
         CASE WHEN s.h IS NULL THEN sha256(c.h) WHEN c.idx % 2 = 0 THEN sha256(c.h || s.h) ELSE sha256(s.h || c.h) END,
         (c.n + 1) // 2, c.proof || coalesce(s.h, '')
  FROM ending c LEFT JOIN tops s ON s.level = c.level AND s.idx = xor(c.idx, 1) WHERE c.n > 1)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, ending.h AS folded_root, ending.h = root.h AS verified
FROM ending, (SELECT h FROM tops WHERE n = 1) root WHERE ending.n = 1
"""

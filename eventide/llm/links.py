"""Connected groups from inverted lists, without all pairs of a list (DataFrame functions only).

A list holds the nodes that share a key.  Near-duplicate operators need the connected
groups of the graph whose edges are the candidate pairs (two nodes of one list) that a
check confirms.  Groups do not need every edge:

1. Each list names a hub, its most central node; every other member is checked against
   it.  That is linear in the list, and joins a group of copies at once.
2. Only pairs of one list whose nodes are *not yet connected* are still needed.  All of
   them are formed, so no group is missed; a list whose members are connected by now
   forms none.

Lists with the same members count once: the first of them in the order of ``rank``, then
key, stands for all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import WORD, discard, scratch_scope, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for the nodes of ``links`` (``a, b``).

    Alternates two steps until nothing changes: each node hands the smallest of its
    neighbourhood to its larger neighbours, then to its smaller ones.  Every step is a
    grouped minimum (combined before its shuffle) and a join; both inputs of the join are
    written tables, so that Spark can split a hub's partition.  Empty input: no rows.
    """
    spark = links.sparkSession
    with scratch_scope(spark):
        edges = written(
            links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
        )
        state = _state(edges)
        while state[0]:
            with scratch_scope(spark):
                edges = _contracted(edges)
            before, state = state, _state(edges)
            if state == before:
                break
        if not state[0]:
            return spark.createDataFrame([], "node long, component long")
        # Stars by now: every node points at its component's smallest.
        stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
            edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        )
        return written(stars, "components", outlives=True)


def _contracted(edges: DataFrame) -> DataFrame:
    """One round of both steps; all edges go from a larger node u to a smaller v."""
    both = written(edges.union(edges.select("v", "u")), "edges")
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    edges = written(large.where("u <> v").distinct(), "edges")
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    small = edges.join(least, "u")
    small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", "m"))
    return written(small.distinct(), "edges", outlives=True)


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(0xFFFFFF))).first())


def linked_groups(
    entries: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    *,
    nodes: DataFrame | None = None,
    condition: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    verify_rest: Callable[[DataFrame], DataFrame] | None = None,
    spent: Sequence[DataFrame] = (),
) -> DataFrame:
    """``node, component`` over all pairs of ``entries`` that share a key and pass ``verify``.

    ``entries``: ``key, node, central`` and, if keys are not in the order of their values, a
    long ``rank`` (one for each key).  ``verify`` takes distinct pairs ``a < b`` and
    returns those confirmed; the tables that it writes go after each call.  ``condition(a, b)``, if given, is tested inside the join of
    the second step, over ``key`` and the columns of ``nodes`` (a row per ``node``): it may
    hold for a pair in one of its lists only, but must where ``verify`` would confirm it; that
    list has to be the pair's first by ``rank``, then key, as others may be left out.
    ``verify_rest`` takes the place of ``verify`` for these pairs, which passed ``condition``.
    ``spent``: written tables that go as soon as nothing reads ``entries`` any more.
    Nodes that nothing is linked with are not in the result.
    """
    spark = entries.sparkSession
    with scratch_scope(spark):
        return written(_linked(entries, verify, nodes, condition, verify_rest or verify, spent), "groups", outlives=True)


def _linked(entries: DataFrame, verify, nodes: DataFrame | None, condition, verify_rest, spent) -> DataFrame:
    spark = entries.sparkSession
    h = F.xxhash64("node")
    rank = F.col("rank") if "rank" in entries.columns else F.lit(0).cast("long")
    # Sums of longs only: Spark keeps them in a hash table.  Nearly all keys end here.
    lists = entries.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.bitwiseAND(0xFFFFFFFF)).alias("y"), F.min(rank).alias("rank")
    )
    lists = lists.where("n > 1").groupBy("n", "x", "y").agg(F.min(F.struct("rank", "key"))["key"].alias("key"))
    with scratch_scope(spark):
        members = written(entries.drop("rank").join(written(lists.select("key"), "lists"), "key"), "members")
        top = members.groupBy("key").agg(F.max(F.struct("central", (-F.col("node")).alias("minus"))).alias("top"))
        hubs = written(top.select("key", (-F.col("top.minus")).alias("hub")), "hubs")
        members = written(members.join(hubs, "key"), "members", outlives=True)
    discard(*spent)

    spokes = members.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    with scratch_scope(spark):
        links = written(verify(written(spokes.distinct(), "hub-pairs")), "links", outlives=True)
    found = components(links)

    labelled = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = written(labelled, "labelled")
    discard(links, members)
    mixed = written(
        labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key"),
        "mixed",
    )
    rest = labelled.drop("central").join(mixed, "key", "left_semi")
    rest = written(rest if nodes is None else rest.join(nodes, "node"), "rest")
    discard(labelled, mixed)
    a, b = rest.alias("a"), rest.alias("b")
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node"))
    on &= (F.col("a.component") != F.col("b.component")) & (F.col("a.node") != F.col("a.hub")) & (F.col("b.node") != F.col("b.hub"))
    if condition is not None:
        on &= condition(lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}"))
    pairs = written(a.join(b, on).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), "rest-pairs")
    discard(rest)
    if pairs.isEmpty():
        return found
    with scratch_scope(spark):
        more = written(verify_rest(pairs), "links", outlives=True)
    if more.isEmpty():
        return found
    # The first round's stars stand for its links.
    stars = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(stars.union(more.select("a", "b")))


def similar_sets_sql(ngram: int, percent: int, last: str = "") -> str:
    """DuckDB SQL of the components of ``documents`` by the similarity of their shingle sets;
    ``last``: further output columns.  Counts all pairs that share a shingle."""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, hash(s) AS s FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - {ngram}, 0) + 2), lambda i: array_to_string(w[i:i + {ngram - 1}], ' '))) AS s
    FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= {percent} * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT edges.y, other FROM reached JOIN edges ON edges.x = reached.doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id{last}
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

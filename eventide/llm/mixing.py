"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

1. Targets.  Each source's share of all words by weight, stopped at ``max_repeats`` times
   its size, the excess reshared by weight.  With the sources in order of cap over weight
   this has a closed form: the common level is the largest of
   ``(total - caps before) / (weights from here on)``.
2. Schedule.  Slot ``t`` stands at the golden-ratio point ``frac((t + 1) * phi)``; the
   source whose part of the cumulative targets holds the point gets the slot.  After any
   number of slots each source has had its share to within a few slots.
3. Stream.  A source's documents in the order of a hash of their id form one stream of
   words, cut into blocks of ``block_words``.  The slot of rank ``r`` of a source takes
   block ``r mod blocks``; the next round begins where the blocks end.
4. Blocks and documents are joined by (source, block).

Ranks and stream positions are running sums by source.  None is taken over a whole
source: each is cut into about sqrt(n) parts of sqrt(n) rows, summed by part first, so a
source with a third of all rows is as parallel as the rest.  What is one row per source
(its size, weight and target) goes through a window over all sources.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import WORD, written

#: The golden ratio's fraction.  A slot's number is split in two, so that doubles hold the points to 1e-8.
_PHI = Decimal("0.61803398874989484820458683436563811772")
_HALF = 1 << 26
_CELLS = 4096


def targets(sizes: DataFrame, max_repeats: int = 3) -> DataFrame:
    """``source, source_size, n_docs, weight, target, lo, hi`` of ``sizes`` (source, size).

    Sources by code point, NULL last, weigh 1, 2, 3, 1, ...; ``lo`` and ``hi`` are the
    source's part of the cumulative targets, from 0 to 1.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "sid")
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    s = s.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", (F.col("sid") - 1) % 3 + 1)
    s = s.withColumn("cap", F.col("source_size") * max_repeats).withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    s = s.withColumn("total", F.sum("source_size").over(everything)).withColumn("level", level)
    s = s.withColumn(
        "target", F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight")).cast("double")
    )
    running = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("hi", F.when(F.col("total") > 0, F.sum("target").over(running) / F.col("total")))
    return s.withColumn("lo", F.lag("hi", 1, 0.0).over(Window.orderBy("sid"))).select(
        "sid", "source", "source_size", "n_docs", "weight", "target", "lo", "hi"
    )


def _part_offsets(rows: DataFrame, keys: list[str], part: str, value) -> DataFrame:
    """``keys, part, before``: the sum of ``value`` over the earlier parts of each key."""
    sums = written(rows.groupBy(*keys, part).agg(value.alias("_sum")), "mix-parts")
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, part, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("before"))


def stream_positions(sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``sizes`` with ``at``: words of the same source before the document in the shuffled stream."""
    h = F.xxhash64(F.lit(seed), F.col("doc"))
    parts = F.ceil(F.sqrt("n_docs"))
    d = sizes.join(sources.select("sid", "source", "n_docs"), sizes["source"].eqNullSafe(sources["source"]))
    d = d.select("sid", "doc", "size", h.alias("h"), F.pmod(h, parts).alias("part"))
    d = written(d, "mix-docs")
    offsets = _part_offsets(d, ["sid"], "part", F.sum("size"))
    inside = (
        Window.partitionBy("sid", "part").orderBy("h", "doc", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return d.join(offsets, ["sid", "part"]).select(
        "sid", "doc", "size", (F.col("before") + F.col("inside")).alias("at")
    )


def scheduled_blocks(sources: DataFrame, n_slots: int, block_words: int, max_repeats: int) -> DataFrame:
    """``sid, block, times``: how often each block is taken in ``n_slots`` slots."""
    spark = sources.sparkSession
    cells = sources.where("target > 0").select(
        "sid",
        "lo",
        "hi",
        F.ceil(F.col("source_size") / block_words).alias("blocks"),
        F.explode(
            F.sequence(F.floor(F.col("lo") * _CELLS), F.least(F.floor(F.col("hi") * _CELLS), F.lit(_CELLS - 1)))
        ).alias("cell"),
    )
    low, high = F.pmod(F.col("id") + 1, F.lit(_HALF)), F.floor((F.col("id") + 1) / _HALF)
    point = low * float(_PHI) + high * float(_PHI * _HALF % 1)
    chunk = max(1, math.isqrt(n_slots))
    slots = spark.range(n_slots).select("id", (point - F.floor(point)).alias("u"))
    slots = slots.select("id", "u", F.floor(F.col("u") * _CELLS).alias("cell"))
    slots = slots.join(cells, "cell").where("u >= lo AND u < hi")
    slots = written(slots.select("id", "sid", "blocks", F.floor(F.col("id") / chunk).alias("chunk")), "mix-slots")
    offsets = _part_offsets(slots, ["sid"], "chunk", F.count("*"))
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("id")) - 1
    ranked = slots.withColumn("inside", inside).join(offsets, ["sid", "chunk"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside"))
    return (
        ranked.where(F.col("rank") < F.col("blocks") * max_repeats)
        .groupBy("sid", (F.col("rank") % F.col("blocks")).alias("block"))
        .agg(F.count("*").alias("times"))
    )


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 32,
    max_repeats: int = 3,
    seed: int = 7,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, source_size, target, taken, source``.

    ``size`` is the number of words, ``target`` the source's, ``taken`` the words the mix
    takes of the document (a word taken twice counts twice); no document gives more than
    ``max_repeats`` times its size.  The same rows give the same mix, however they lie.

    NULL or empty text: size 0, nothing taken.  NULL source: a source of its own, last in
    order.  NULL ids are mixed like others; rows that repeat an id are documents of their
    own (rows equal in id, source and size get their takes in any order).  Other columns
    are not read.  Empty input, or no word at all: nothing taken, target 0.
    """
    size = F.size(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    sizes = docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), size.alias("size"))
    sizes = written(sizes, "mix-sizes")
    sources = written(targets(sizes, max_repeats), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    placed = written(stream_positions(sizes, sources, seed), "mix-placed")
    times = scheduled_blocks(sources, -(-total // block_words), block_words, max_repeats)

    b = F.col("block")
    overlap = F.least(F.col("at") + F.col("size"), (b + 1) * block_words) - F.greatest(F.col("at"), b * block_words)
    pieces = placed.where("size > 0").withColumn(
        "block",
        F.explode(
            F.sequence(
                F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words)
            )
        ),
    )
    # A place in a source's stream is one document's alone, so it tells repeated ids apart.
    taken = (
        pieces.join(times, ["sid", "block"])
        .groupBy("sid", "at", "doc", "size")
        .agg(F.sum(overlap * F.col("times")).alias("taken"))
    )
    some = placed.where("size > 0").join(taken.select("sid", "at", "taken"), ["sid", "at"], "left")
    none = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        some.unionByName(none.select(*some.columns))
        .join(sources.select("sid", "source", "source_size", "target"), "sid")
        .select(
            F.col("doc").alias(id_col),
            "size",
            "source_size",
            "target",
            F.coalesce(F.col("taken"), F.lit(0)).cast("long").alias("taken"),
            "source",
        )
    )

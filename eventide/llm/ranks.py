"""Positions within groups of any size, without a task for a group (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import written
from eventide.session import partitions_for

#: ``monotonically_increasing_id`` has the partition above this bit.
_PARTITION_BIT = 33


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` (best a written table: it is read twice) with ``pos``, from 0, of each row in its
    ``group`` by ``order`` (ascending, NULLs first) and ``total``, the rows of the group.

    Rows are dealt out by ranges of (group, order), so a group spans as many tasks as it needs.
    Only a count for each group and range is summed up by group.  NULL is a group of its own.
    """
    ranged = df.repartitionByRange(partitions_for(df), group, *order).sortWithinPartitions(group, *order)
    ranged = written(ranged.withColumn("_row", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_row", _PARTITION_BIT))
    spans = ranged.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_span")).agg(F.count("*").alias("n"), F.min("_row").alias("_first"))
    parts = Window.partitionBy("_group")
    before = parts.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "_group", "_span", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"), F.sum("n").over(parts).alias("total")
    )
    spans = written(spans, "spans")
    on = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_span"))
    return ranged.join(spans, on).select(*df.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias("pos"), "total")

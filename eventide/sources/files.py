"""JSON-lines files of a replay (the batch reader's output).

The replay is written range-partitioned by date and sorted inside each file,
so the part files read in name order give the whole replay in date order and
no single task writes everything.  ``single_file=True`` gives the one-file
layout (``coalesce(1)``) for small replays.  The folder is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import CHANGE_LOG, DATE_EVENT, ID, SEQ, SNAPSHOT_COLUMNS
from ..session import partitions_for

REPLAY_SCHEMA = "id string, date_event bigint, event_type string, location string, lat double, lng double"


def write_replay_json(replay: DataFrame, path: str, single_file: bool = False, partitions: int | None = None) -> None:
    rows = replay.select(*SNAPSHOT_COLUMNS)
    if single_file:
        rows = rows.orderBy(DATE_EVENT, ID).coalesce(1)
    else:
        n = partitions or partitions_for(rows)
        rows = rows.repartitionByRange(n, DATE_EVENT, ID).sortWithinPartitions(DATE_EVENT, ID)
    rows.write.mode("overwrite").json(path)


def read_replay_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPLAY_SCHEMA).json(path)


def write_change_log(changes: DataFrame, path: str, partitions: int | None = None) -> None:
    """Store the flat change log range-partitioned and sorted by date: each file
    covers a date range, so Parquet min/max statistics let ``date_event``
    filters of the time-travel queries skip whole files and row groups."""
    cols = [f.name for f in CHANGE_LOG.fields]
    rows = changes.select(*cols)
    ranged = rows.repartitionByRange(partitions or partitions_for(rows), DATE_EVENT, ID)
    ranged.sortWithinPartitions(DATE_EVENT, ID, SEQ).write.mode("overwrite").parquet(path)


def read_change_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHANGE_LOG).parquet(path)

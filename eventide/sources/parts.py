"""Tables that grow by parts: a plain Parquet table partitioned by ``version``.

Each micro-batch writes one part, ``version=<batch number + 1>``, and nothing else: what is
written follows the batch and not the table.  A batch that is given again replaces its own
part, so rows are never doubled.  A part is visible when its write is committed; the table as of
a version is the parts up to it, by a filter on the partition column.

Two kinds of table use it: logs, whose rows are added once (changes, late events, segments of
histories), and keyed tables, where a later part's row replaces an earlier one of the same
key (:func:`latest`).  A keyed table's parts up to a version can be folded into one
(:func:`compact`), which readers then start from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "version"
_PARTS, _BASE = "parts", "base"


def _folder(path: str, kind: str) -> str:
    return f"{path.rstrip('/')}/{kind}"


def _write(rows: DataFrame, path: str, kind: str, version: int) -> None:
    rows.write.mode("overwrite").parquet(f"{_folder(path, kind)}/{VERSION}={version}")


def _read(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])).parquet(_folder(path, kind))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table of parts at ``path``."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(path, _PARTS))
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)


def ensure(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create the table, empty (version 0), if there is none."""
    if not exists(spark, path):
        empty = spark.createDataFrame([], schema)
        _write(empty, path, _BASE, 0)
        _write(empty, path, _PARTS, 0)


def write_part(rows: DataFrame, path: str, version: int) -> None:
    """``rows`` as part ``version`` (1 and up); a part of that number is replaced."""
    if version < 1:
        raise ValueError("parts are numbered from 1")
    _write(rows, path, _PARTS, version)


def read_parts(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """The rows of all parts, or of those up to a version, with ``version``."""
    rows = _read(spark, path, _PARTS, schema)
    return rows if upto is None else rows.where(F.col(VERSION) <= upto)


def latest(
    spark: SparkSession, path: str, schema: T.StructType, key: str, upto: int | None = None, guard: str | None = None
) -> DataFrame:
    """A keyed table: of each key the row of the last part (``guard``: with the largest value,
    then the last part), by partial aggregation.

    A part has one row per key at most.  Starts from the last compacted version."""
    base = _read(spark, path, _BASE, schema)
    base = base if upto is None else base.where(F.col(VERSION) <= upto)
    start = base.agg(F.max(VERSION)).first()[0] or 0
    rows = base.where(F.col(VERSION) == start).union(read_parts(spark, path, schema, upto).where(F.col(VERSION) > start))
    rank = [F.col(VERSION)] if guard is None else [F.col(guard), F.col(VERSION)]
    last = F.max_by(F.struct(*[f.name for f in schema.fields if f.name != key]), F.struct(*rank))
    best = rows.groupBy(key).agg(last.alias("_last"))
    return best.select(*[F.col(key) if f.name == key else F.col(f"_last.{f.name}") for f in schema.fields])


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str, version: int, guard: str | None = None) -> None:
    """Fold the parts of a keyed table up to ``version`` into one; the parts stay, for earlier versions."""
    _write(latest(spark, path, schema, key, version, guard), path, _BASE, version)

"""The latest-state table: create if absent, read (at a version), upsert.

With the Delta Lake package on the classpath (``format="delta"``) these are
``DeltaTable`` calls: ``MERGE`` and ``versionAsOf``.  Without it the table is a
folder of Parquet snapshots ``v=<n>`` under a shared path; an upsert writes the
merged rows as the next snapshot.  A snapshot counts once it is complete, so a failed
write is not seen, and giving the same rows again changes nothing but the version.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSION = re.compile(r"^v=(\d+)$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed snapshot versions (those with a ``_SUCCESS`` marker), ascending."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        m = _VERSION.match(st.getPath().getName())
        if m and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def _vpath(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v={version:010d}"


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> int:
    """Create an empty table with ``schema`` if there is none; returns its version."""
    if fmt == "delta":
        from delta.tables import DeltaTable  # type: ignore[import-not-found]

        if not DeltaTable.isDeltaTable(spark, path):
            spark.createDataFrame([], schema).write.format("delta").mode("overwrite").save(path)
        return int(DeltaTable.forPath(spark, path).history(1).select("version").first()[0])
    have = versions(spark, path)
    if have:
        return have[-1]
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(_vpath(path, 0))
    return 0


def read_table(spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The table at ``version`` (default: the latest)."""
    if fmt == "delta":
        reader = spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        return reader.load(path)
    have = versions(spark, path)
    if not have:
        raise FileNotFoundError(f"no table at {path}")
    v = have[-1] if version is None else version
    if v not in have:
        raise ValueError(f"version {v} not in {have}")
    return spark.read.parquet(_vpath(path, v))


def merged(target: DataFrame, source: DataFrame, key: str, guard: str | None = None) -> DataFrame:
    """Rows of ``target`` updated / extended by ``source`` (one row per key).

    ``guard=None``: matched rows are replaced unconditionally.  ``guard="date_event"``: a matched row is replaced only when
    the source value is not older, so out-of-order batches cannot roll back."""
    source = source.select(*target.columns)
    s = source.alias("s")
    t = target.alias("t")
    j = s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"), "full_outer")
    newer = F.lit(True) if guard is None else F.col(f"s.{guard}") >= F.col(f"t.{guard}")
    take_s = F.col(f"t.{key}").isNull() | (F.col(f"s.{key}").isNotNull() & newer)
    cols = [F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    return j.select(*cols)


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    version: int | None = None,
    guard: str | None = None,
    fmt: str = "parquet",
) -> int:
    """MERGE ``source`` (one row per key) into the table; returns the new version.

    ``version``: the version to write; by default the one after the table's last."""
    if fmt == "delta":
        from delta.tables import DeltaTable  # type: ignore[import-not-found]

        tbl = DeltaTable.forPath(spark, path).alias("t")
        cond = f"s.{key} = t.{key}"
        m = tbl.merge(source.alias("s"), cond)
        m = m.whenMatchedUpdateAll(condition=None if guard is None else f"s.{guard} >= t.{guard}")
        m.whenNotMatchedInsertAll().execute()
        return int(DeltaTable.forPath(spark, path).history(1).select("version").first()[0])
    have = versions(spark, path)
    if version is None:
        version = (have[-1] + 1) if have else 1
    base = [v for v in have if v < version]
    if base:
        target = spark.read.parquet(_vpath(path, base[-1]))
        out = merged(target, source, key, guard)
    else:
        out = source
    out.write.mode("overwrite").parquet(_vpath(path, version))
    return version

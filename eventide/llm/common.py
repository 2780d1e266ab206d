"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import shared_path

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: DuckDB: the CRC-32 of the decimal form of ``{}``, bit by bit.
CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(({})::VARCHAR, ''), lambda z: ascii(z)::BIGINT)),"
    " lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],"
    " lambda q, _: CASE WHEN q & 1 = 1 THEN xor(q >> 1, 3988292384) ELSE q >> 1 END)), 4294967295)"
)

#: Spark drops a statement's shuffle files at its end: what it wrote is read from then on.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_ROOTS: dict[str, str] = {}
#: The written tables of each open ``scratch_scope``, the innermost last.
_SCOPES: list[list[str]] = []
#: Where each written table is.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch(spark: SparkSession) -> str:
    """This application's folder for written tables, under ``spark.checkpoint.dir``.

    The driver and all executors see it.  It is removed when the driver ends, as the
    frames read from it are lazy and may be used until then.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = _ROOTS[app] = shared_path(spark, "llm", app, unique=True)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()

        def remove() -> None:
            try:
                path = jvm.org.apache.hadoop.fs.Path(root)
                path.getFileSystem(conf).delete(path, True)
            except Exception:  # noqa: BLE001 - the JVM may have gone first
                pass

        atexit.register(remove)
    return _ROOTS[app]


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written within are removed at its end, so that they take no disk any longer.

    A frame that goes on being used must read none of them but those written with
    ``outlives=True``; they belong to the scope around this one."""
    _SCOPES.append([])
    try:
        yield
    finally:
        _remove(spark, _SCOPES.pop())


def discard(*tables: DataFrame) -> None:
    """Removes written tables that nothing reads any more before their scope ends."""
    for df in tables:
        _remove(df.sparkSession, [_PATHS.pop(df)])


def _remove(spark: SparkSession, names: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch(spark)}/{label}-{uuid.uuid4().hex[:10]}"


def written(df: DataFrame, label: str, *, outlives: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage (a lost executor loses nothing of it) and leaves the next join
    free to choose, and to split, its own partitions.  ``outlives``: see ``scratch_scope``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if len(_SCOPES) > outlives:
        _SCOPES[-2 if outlives else -1].append(path)
    schema = df.schema
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    out = spark.read.schema(schema).parquet(path)
    _PATHS[out] = path
    return out


def words(text: Column) -> Column:
    """The array of words of a text (empty for NULL)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Session helpers: a local session for tests and the bench, and the shared
folder (``spark.checkpoint.dir``) used for checkpoints, tables and stream state.

On a cluster ``spark.checkpoint.dir`` must name a shared file system path; it is
read from the session and never replaced.  Only a local-mode session with no
setting gets a scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "eventide") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Larger Arrow batches for the pandas passes (fewer JVM<->Python round trips).
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Checkpoints that nothing refers to any more are removed.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Python workers talk to the JVM over a unix socket: no TCP port for state.
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()  # Option[String]
    return jdir.get() if jdir.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a scratch one is set only in local mode."""
    current = _context_checkpoint_dir(spark)
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    path = tempfile.mkdtemp(prefix="eventide-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return _context_checkpoint_dir(spark) or path


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (tables, stream checkpoints)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([base, "eventide", *tail]) if tail else base


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` importable in Python workers (``addPyFile`` of a zip of
    the package, once per context).  Needed by the operators that run pandas
    code in tasks; a no-op after the first call."""
    sc = spark.sparkContext
    token = sc.applicationId
    if token in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="eventide-pkg-"), "eventide.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(token)


def estimated_bytes(df) -> int | None:
    """Optimizer size estimate of a frame (None when unknown)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return None if size >= (1 << 62) else size


def partitions_for(df) -> int:
    """Partition count for an explicit shuffle of ``df``: its estimated size over
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (the size AQE aims for), at
    least ``defaultParallelism``; ``spark.sql.shuffle.partitions`` when the size is
    unknown."""
    spark = df.sparkSession
    size = estimated_bytes(df)
    if size is None:
        return shuffle_partitions(spark)
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    return int(max(spark.sparkContext.defaultParallelism, -(-size // max(_bytes(advisory), 1))))


def _bytes(text: str) -> int:
    text = str(text).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
             "t": 1 << 40, "tb": 1 << 40}
    for suffix in sorted(units, key=len, reverse=True):
        if text.endswith(suffix):
            return int(float(text[: -len(suffix)]) * units[suffix])
    return int(text)

"""Session helpers: where intermediate tables go, and how to freeze a frame."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"

_local_base: str | None = None
_made: list[str] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "oreflow") -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # Python call sites in error texts cost milliseconds per Column; plans have hundreds.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that all executors read it alike."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return place.makeQualified(system.getUri(), system.getWorkingDirectory()).toString().rstrip("/")


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; without that, it is the warehouse, where all
    executors write and read tables anyway. A path without a scheme lies in the default file system,
    as Spark itself takes it. Only a session whose tasks run in the driver may fall back to a
    temporary folder: executors have temporary folders of their own.
    """
    global _local_base
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return _qualified(spark, configured or spark.conf.get(WAREHOUSE_KEY))
    if configured:
        return configured.rstrip("/")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="oreflow-")
        spark.sparkContext.setCheckpointDir(f"file://{_local_base}/checkpoints")
    return f"file://{_local_base}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder for one job's intermediate tables, checkpoints or models."""
    path = f"{shared_base(spark)}/oreflow/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def is_kept(path: str) -> bool:
    """Whether a scratch folder of this process is still there."""
    return path in _made


def clear_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the folders made by this process (those after the first ``since``); how many there were."""
    base = shared_base(spark)
    paths, _made[since:] = [p for p in _made[since:] if p.startswith(f"{base}/")], []
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Whatever the block makes in the shared folder is gone after it; read its results inside."""
    since = len(_made)
    try:
        yield
    finally:
        clear_scratch(spark, since)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame and read it back.

    Freezes random or time-dependent columns, and cuts the lineage onto shared storage, so a
    lost executor costs a re-read and not a recomputation.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

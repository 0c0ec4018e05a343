"""Session helpers: a tuned session and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: adaptive execution merges shuffle partitions up to about this size, and splits skewed ones down to it
PARTITION_BYTES = 128 * 1024 * 1024
#: what a shuffle on a cluster is taken to move at most, where nothing better is known
LARGEST_SHUFFLE_BYTES = 2 * 1024**4


def build_session(
    app: str = "filmgrid",
    master: str | None = None,
    cores: int | None = None,
    largest_shuffle_bytes: int | None = None,
) -> SparkSession:
    """A session with adaptive execution on.

    ``master`` and ``cores`` are for local runs. Elsewhere shuffles start with as many partitions of 128 MB as
    ``largest_shuffle_bytes`` needs, since adaptive execution merges partitions that turn out small but never adds any.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PARTITION_BYTES))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # recording the Python call site of every column expression takes longer than planning small queries
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        # a local session has one process for everything, and the default of 1 GB spills early
        builder = (
            builder.master(master).config("spark.driver.host", "127.0.0.1").config("spark.driver.memory", "8g")
        )
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores)).config(
            "spark.default.parallelism", str(cores)
        )
    if largest_shuffle_bytes or not (master or "").startswith("local"):
        partitions = max(200, -(-(largest_shuffle_bytes or LARGEST_SHUFFLE_BYTES) // PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder for written intermediates, which the cluster names in ``spark.checkpoint.dir`` and all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    path = f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _owned:
        _owned[-1].append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For frames that several passes go over: what computed them runs once, and lost executors cost a re-read only. The
    files belong to the innermost ``scratch`` block around the call, which removes them; outside of one they stay for
    as long as the caller wants to read them.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_owned: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, every path that ``written`` and ``fresh_path`` have handed out inside.

    Results that read such files must be written or collected before the block ends.
    """
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            delete_path(spark, path)


def _file_system(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def path_exists(spark: SparkSession, path: str) -> bool:
    system, there = _file_system(spark, path)
    return system.exists(there)


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder with all that is in it; nothing happens if it is not there."""
    system, there = _file_system(spark, path)
    system.delete(there, True)


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path."""
    system, there = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(there) if f.isDirectory()) if system.exists(there) else []


def bytes_below(spark: SparkSession, path: str) -> int:
    """Size of all files below a path."""
    system, there = _file_system(spark, path)
    return system.getContentSummary(there).getLength() if system.exists(there) else 0

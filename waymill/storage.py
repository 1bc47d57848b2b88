"""Shared storage for intermediate tables.

Intermediate results that several branches read are written once as Parquet to
the folder the cluster names in ``spark.checkpoint.dir`` and read back.  That

* keeps the work when executors are lost,
* gives Catalyst true file sizes, so that it broadcasts a side only when its
  measured size is below ``spark.sql.autoBroadcastJoinThreshold``,
* leaves a side without a hash partitioning of its own, so that adaptive
  execution may split hot keys in a later join,
* lets go of what was shuffled for it as soon as it is written.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_session_folders: dict[str, str] = {}
# The folders given out within the innermost ``passing_folders``.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
# Without it shuffle files stay until the driver happens to collect its garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary folder only in local mode."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not _one_process(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_root is None:
        # With its scheme, as the default file system may be another.
        _local_root = Path(tempfile.mkdtemp(prefix="waymill-")).as_uri()
    return _local_root


def _one_process(spark: SparkSession) -> bool:
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def _reached_root(spark: SparkSession) -> str:
    """``shared_root``, or where none is set the folder of Spark's own checkpoints or else the warehouse, which executors reach as well.

    A folder that may be each machine's own (a path of the local file system that is not set with its scheme) is tried out first.
    """
    try:
        root = shared_root(spark)
    except ValueError:
        root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        tried = False
    else:
        tried = ":" in root or _one_process(spark)
    if not tried and file_system(spark, root)[0].getScheme() == "file":
        _try_out(spark, root)
    return root


def _try_out(spark: SparkSession, root: str) -> None:
    """Fails unless what tasks write below ``root`` is seen by the driver and by other tasks."""
    path = f"{root}/waymill/tried-{uuid.uuid4().hex}"
    tasks = max(2, spark.sparkContext.defaultParallelism)
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        seen = spark.read.schema("id BIGINT").parquet(path).count()
    except Exception as error:
        raise ValueError(f"executors cannot write to {root}: set spark.checkpoint.dir to a folder that all of them can reach") from error
    finally:
        files, hadoop_path = file_system(spark, path)
        files.delete(hadoop_path, True)
    if seen < tasks:
        raise ValueError(f"{root} is each machine's own folder: set spark.checkpoint.dir to one that all executors can reach")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as it knows it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _session_folder(spark: SparkSession) -> str:
    """One folder per application below the shared folder, removed when its driver ends."""
    application = spark.sparkContext.applicationId
    if application not in _session_folders:
        path = f"{_reached_root(spark)}/waymill/{application}-{uuid.uuid4().hex}"
        files, hadoop_path = file_system(spark, path)
        files.mkdirs(hadoop_path)
        files.deleteOnExit(hadoop_path)
        _session_folders[application] = path
    return _session_folders[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused path for intermediate data (not created yet)."""
    path = f"{_session_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return path


@contextmanager
def scratch_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A fresh folder for intermediate data that is removed when the block ends."""
    path = new_folder(spark, purpose)
    try:
        yield path
    finally:
        files, hadoop_path = file_system(spark, path)
        files.delete(hadoop_path, True)


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Removes, when the block ends, all folders that ``new_folder`` has given out within it.

    What is to stay goes to a folder taken before the block; results that still read the others must be stored within it.
    """
    token = _passing.set(paths := [])
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            files, hadoop_path = file_system(spark, path)
            files.delete(hadoop_path, True)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What writes within the block have shuffled is removed as each of them ends (unless the session sets that otherwise)."""
    conf = spark.conf
    unset = conf.get(_SHUFFLE_CLEANUP, None) is None
    if unset:
        conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if unset:
            conf.unset(_SHUFFLE_CLEANUP)


def materialize(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to ``path`` as Parquet and return a scan of what was written; what was shuffled for it is removed (unless set otherwise).

    ``codec`` is that of the files, the session's by default.
    """
    writer = df.write.mode("errorifexists")
    if codec:
        writer = writer.option("compression", codec)
    with passing_shuffles(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

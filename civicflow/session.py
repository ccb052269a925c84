"""Spark session defaults and the shared storage root."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a job of this shape; the cluster's own settings win where present.
_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "civicflow",
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Session for jobs and tests. ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage.
    Only when it is unset (local runs, tests) do we create one and register it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to storage that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="civicflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never reused path under the shared root."""
    return "/".join([shared_root(spark), *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local filesystem helpers."""
    return path[5:] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories under ``path`` (none if it is not there), through the Hadoop filesystem."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()) if fs.exists(hpath) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files under ``path`` (none if it is not there), through the Hadoop filesystem."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isFile()) if fs.exists(hpath) else []


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file (and its directory); false if it is there already. One of several callers at once gets true."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath.getParent())
    return bool(fs.createNewFile(hpath))


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a directory with all it holds, through the Hadoop filesystem; nothing if it is not there."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def is_local_fs(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


__all__ = ["build_session", "shared_root", "scratch_path", "path_exists", "list_dirs", "list_files", "create_file", "remove_dir", "local_path", "is_local_fs"]

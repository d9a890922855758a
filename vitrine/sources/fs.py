"""Minimal file-system helpers on the cluster's Hadoop file system (paths on any
store Spark can read: HDFS, object stores, local)."""

from __future__ import annotations

from pyspark.sql import SparkSession

__all__ = ["path_exists", "delete_path", "glob_paths", "move_file", "stored_bytes"]


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path``; False when it did not exist."""
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a glob pattern (none: empty, no error)."""
    fs, p = _fs_path(spark, pattern)
    return [str(f.getPath().toString()) for f in fs.globStatus(p) or []]


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename one file, replacing the target and making its folder."""
    fs, p = _fs_path(spark, target)
    fs.mkdirs(p.getParent())
    fs.delete(p, False)
    if not fs.rename(_fs_path(spark, source)[1], p):
        raise OSError(f"could not move {source} to {target}")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder."""
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength())

"""Folders of a path's own file system: whether they exist, how partition folders are named, and their removal.

Metadata only, through the Hadoop file system that Spark's writers use for the path; no data is read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _located(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; nothing happens if it is not there."""
    fs, target = _located(spark, path)
    fs.delete(target, True)


def make(spark: SparkSession, path: str) -> None:
    fs, target = _located(spark, path)
    fs.mkdirs(target)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file, replacing one of that name."""
    fs, target = _located(spark, path)
    remove(spark, to)
    if not fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot move {path} to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, target = _located(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def partition_name(spark: SparkSession, column: str, value: str | None) -> str:
    """``column=value`` as Spark's partitioned writers spell the folder."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, value)

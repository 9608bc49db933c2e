"""Folders on whatever file system a path names, by Hadoop's own client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; of a folder that is not there, none."""
    where, fs = _at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(where)) if fs.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _at(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _at(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Whether the folder ``source`` is now ``target``; False if there is a ``target``."""
    where, fs = _at(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(to):
        return False
    fs.mkdirs(to.getParent())
    return fs.rename(where, to)

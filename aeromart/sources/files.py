"""The few file-system questions a load asks, through Hadoop so that any shared store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def make_dir(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def changed_at(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which the file or folder was last changed."""
    fs, where = _at(spark, path)
    return fs.getFileStatus(where).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all below it; nothing happens if it is not there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def write_empty(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.create(where, True).close()

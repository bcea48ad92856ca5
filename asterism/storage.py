"""The few file-system calls Spark has no DataFrame API for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, location: str) -> str:
    path, files = _path(spark, location)
    return files.makeQualified(path).toString()


def exists(spark: SparkSession, location: str) -> bool:
    path, files = _path(spark, location)
    return files.exists(path)


def delete(spark: SparkSession, location: str) -> None:
    path, files = _path(spark, location)
    files.delete(path, True)

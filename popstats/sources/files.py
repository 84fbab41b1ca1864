"""Folders of the shared file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever the session's file system keeps it; a missing one is no error."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

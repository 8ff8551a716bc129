"""Names, sizes and deletions on whatever store a path lies on, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Files and folders directly under a folder; none where it does not exist."""
    place, fs = _place(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder; none where it does not exist."""
    place, fs = _place(spark, path)
    return fs.getContentSummary(place).getLength() if fs.exists(place) else 0


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    place, fs = _place(spark, path)
    fs.delete(place, True)

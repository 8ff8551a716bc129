"""Which files a load has taken: a table of paths, times and sizes that grows with every load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.sources.storage import names

_SEEN = "path string, modified timestamp, bytes long"


class Ledger:
    """``path`` is on storage all executors share; it holds one row for each file taken."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def seen(self) -> DataFrame:
        if not names(self.spark, self.path):
            return self.spark.createDataFrame([], _SEEN)
        return self.spark.read.schema(_SEEN).parquet(self.path)

    def unread(self, root: str, pattern: str = "*.json*") -> DataFrame:
        """path, modified, bytes of the files under ``root`` that no load has taken, or that
        have been written anew since. Files are listed, not opened."""
        there = self.spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
            "recursiveFileLookup", "true").load(root).select(
            "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
        return there.join(self.seen(), ["path", "modified", "bytes"], "left_anti")

    def record(self, files: DataFrame) -> None:
        """Note the files as taken; call it when what they hold is safe."""
        files.select("path", "modified", "bytes").write.mode("append").parquet(self.path)

"""Keeping one row per key, and dense ids.

``row_number() = 1`` lets Catalyst keep one row per key in every map task before the
shuffle (WindowGroupLimit), so a key that holds a third of the table sends only one row
per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.functions.text import duplicate_key
from jobloom.session import checkpoint


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``; make the order total for a stable result."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def newest_posting(df: DataFrame, text_hash: Column | None = None) -> DataFrame:
    """One row per (title, company, location), the newest.

    Full ties are settled by the description's hash, which may be handed in for rows that
    leave their texts elsewhere.
    """
    key = duplicate_key("title", "company", "location")
    return first_per_key(df.withColumn("_dup", key), ["_dup"], _newest_first(text_hash)).drop(
        "_dup")


def newest_per_job(df: DataFrame, text_hash: Column | None = None) -> DataFrame:
    return first_per_key(df, ["job_id"], _newest_first(text_hash))


def _newest_first(text_hash: Column | None = None) -> list[Column]:
    text_hash = F.xxhash64("description") if text_hash is None else text_hash
    return [
        F.col("posted_ts").desc_nulls_last(), F.col("job_id").asc(),
        F.col("url").asc(), F.col("title").asc(), F.col("salary_mid").desc_nulls_last(),
        text_hash.asc(),
    ]


def first_question(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return first_per_key(df, ["question"], order)


def distinct_pairs(df: DataFrame, key: str, value: str = "skill") -> DataFrame:
    return df.select(key, value).dropDuplicates([key, value])


def first_seen(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First arrival of each id; rows without an id are dropped."""
    return first_per_key(df.filter(F.col(key).isNotNull() & (F.col(key) != "")), [key], order)


def distinct_in_order(df: DataFrame, value: str, rank: str) -> DataFrame:
    """Distinct values with the rank of their first appearance, in that order."""
    return df.groupBy(value).agg(F.min(rank).alias(rank)).orderBy(rank, value)


def dense_ids(df: DataFrame, order: Sequence[Column], id_column: str) -> DataFrame:
    """Ids 1..n following ``order``.

    The rows are range-partitioned, sorted inside their partitions and checkpointed, which
    fixes which partition holds which row. An id is then the row's place in its partition
    plus the sizes of the partitions before it; only those sizes (one row per partition)
    meet in a single task.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = checkpoint(df.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    placed = fixed.select(
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        "*",
    )
    sizes = fixed.groupBy(F.spark_partition_id().alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return placed.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_place") + 1).alias(id_column), *df.columns
    )

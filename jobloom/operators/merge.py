"""Set-based upserts: the new table content as one join of target and stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from jobloom.functions.values import posted_timestamp, without_zone
from jobloom.functions.vectors import checked_vector, to_vector


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are missing or occur more than once, with their row count."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | missing)


def upsert(target: DataFrame, stage: DataFrame, keys: Sequence[str],
           update_columns: Sequence[str]) -> DataFrame:
    """Insert unknown keys; on a match replace only ``update_columns``.

    Each side must be unique on ``keys``. A target bucketed on its key is not shuffled.
    """
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("_in_target"))
    s = stage.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in target.columns if c not in keys],
                     F.lit(True).alias("_in_stage"))
    joined = t.join(s, list(keys), "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in update_columns:
            out.append(F.when(F.col("_in_stage"), F.col(f"_s_{c}"))
                       .otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_in_target"), F.col(f"_t_{c}"))
                       .otherwise(F.col(f"_s_{c}")).alias(c))
    return joined.select(*out)


def new_pairs(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage rows whose key the target lacks, once each."""
    rows = stage.select(*keys).dropDuplicates(list(keys))
    return rows.join(target.select(*keys), list(keys), "left_anti")


def upsert_vectors(target: DataFrame, stage: DataFrame, id_column: str, dim: int) -> DataFrame:
    """Replace or add whole vectors; ids take the target's type, vectors become float32."""
    id_type = target.schema[id_column].dataType
    ready = stage.select(
        F.col(id_column).cast(id_type).alias(id_column),
        checked_vector(to_vector("embedding"), dim).alias("embedding"),
    )
    return upsert(target, ready, [id_column], ["embedding"])


def coerce_jobs(df: DataFrame) -> DataFrame:
    """Make a jobs frame loadable: bad timestamps to null, zones dropped, ``dt`` filled in."""
    out = df
    if "posted_ts" in df.columns:
        out = out.withColumn("posted_ts", posted_timestamp(without_zone("posted_ts")))
    if "dt" in df.columns:
        return out.withColumn("dt", F.to_date(posted_timestamp(without_zone("dt"))))
    if "posted_ts" in df.columns:
        return out.withColumn("dt", F.to_date("posted_ts"))
    return out.withColumn("dt", F.current_date())

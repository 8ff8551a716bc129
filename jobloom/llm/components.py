"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.session import checkpoint


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One half step: every node hands its smallest neighbour to the neighbours above it
    (large), or to those below it and itself (small)."""
    both = links.select("u", "v").union(links.select("v", "u")) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    seen = both.join(least, "u")
    low = F.least("u", "least")
    if large:
        out = seen.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), low.alias("v"))
    else:
        out = seen.select(F.col("v").alias("u"), low.alias("v")).union(
            least.select("u", F.col("least").alias("v")))
    return out.filter(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """node, root: the smallest node reachable, for every node with a link to another node.

    Large and small star steps alternate until nothing changes; the number of rounds grows
    with the logarithm of the number of nodes, also for chains. Every round is pre-aggregated
    and checkpointed. No links give no rows.
    """
    pair = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    now = checkpoint(pair.filter("u > v").distinct())
    state = _state(now)
    while True:
        now = checkpoint(_stars(_stars(now, True), False))
        new = _state(now)
        if new == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new


def _state(links: DataFrame) -> tuple:
    """Two sums that both stay only when the links do."""
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]

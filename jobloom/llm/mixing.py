"""Mixing sources to target weights: Sainte-Lague quotas of equal-word blocks.

Documents are dealt over shards of bounded size by a seeded hash. In every shard the blocks
are given to the sources one by one to the highest quotient (target words divided by the odd
numbers), which makes an integer quota per shard and source. A source's documents stand in
seeded order in their shard, and its quota takes their words block by block from the first on,
around again when the quota is larger than the source.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from jobloom.llm.words import known, word_count, whole_row
from jobloom.session import checkpoint

WEIGHTS = (1, 2, 3)       # of the sources in order, repeating
MOST_TIMES = 3            # no source and no word is taken more often
SHARD_WORDS = 1 << 16     # words of a shard, about
BLOCK_WORDS = 4           # words of a block: rounding error of a source in a shard
SEED = 20260


def targets(sizes: list[int], weights: list[float], most: float = MOST_TIMES) -> list[float]:
    """Shares of all words by weight; what exceeds ``most`` times a source goes to the others
    by weight, until none exceeds it. Without words all targets are zero."""
    out: list[float | None] = [None] * len(sizes)
    left = float(sum(sizes))
    while True:
        open_ = [i for i, x in enumerate(out) if x is None]
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            return [float(x) for x in out]
        for i in over:
            out[i] = float(most * sizes[i])
        left = float(sum(sizes)) - sum(x for x in out if x is not None)


def apportion(weights: list[float], caps: list[int], seats: int) -> list[int]:
    """Sainte-Lague with caps: each seat goes to the highest weight / (2 * seats so far + 1),
    ties to the first.

    A bound is searched above which there are at most so many quotients, and but for a few all.
    What lies above it is given at once, less one seat of each, as rounding may have added
    that one; the last seats are given one by one.
    """
    w = np.asarray(weights, np.float64)
    c = np.where(w > 0, np.asarray(caps, np.int64), 0)
    seats = min(seats, int(c.sum()))
    if seats <= 0:
        return [0] * len(w)
    given = np.zeros(len(w), np.int64)
    low, high = 0.0, 2 * float(w.max()) + 1.0
    bound = min(float(w.sum()) / (2 * seats), high / 2)
    while low < bound < high:
        above = np.minimum(c, np.floor((w / bound + 1) / 2)).astype(np.int64)
        if above.sum() > seats:
            low = bound
        else:
            high, given = bound, above
            if seats - above.sum() <= len(w):
                break
        bound = (low + high) / 2
    given = np.maximum(given - 1, 0).tolist()
    queue = [(-x / (2 * g + 1), i) for i, (x, g) in enumerate(zip(w.tolist(), given)) if g < c[i]]
    heapq.heapify(queue)
    for _ in range(seats - sum(given)):
        _, i = heapq.heappop(queue)
        given[i] += 1
        if given[i] < c[i]:
            heapq.heappush(queue, (-float(w[i]) / (2 * given[i] + 1), i))
    return given


def _quotas(group: pd.DataFrame) -> pd.DataFrame:
    """Blocks of each source of one shard. The last block of a cell may be partial. Sources at
    ``MOST_TIMES`` take all their blocks; the others share theirs out."""
    group = group.sort_values("rank")
    caps = [-(-MOST_TIMES * int(n) // BLOCK_WORDS) for n in group["words"]]
    full = group["target"] >= MOST_TIMES * group["source_size"]
    want = (group["target"] * group["words"] / group["source_size"].clip(lower=1)).mask(full, 0.0)
    shared = apportion(want.tolist(), caps, round(want.sum() / BLOCK_WORDS))
    blocks = [cap if f else n for f, cap, n in zip(full, caps, shared)]
    return group.assign(blocks=blocks)[["shard", "rank", "words", "blocks"]]


def source_targets(rows: DataFrame) -> tuple[DataFrame, int]:
    """One row per source (_source, rank, source_size, target), and all words. The table has one row per
    source, which is what the weights are written for; it passes through the driver."""
    found = rows.groupBy("_source").agg(F.sum("size").alias("n")).collect()
    found.sort(key=lambda r: (r._source is None, r._source or ""))
    sizes = [int(r.n) for r in found]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))]
    goal = targets(sizes, weights) if found else []
    return rows.sparkSession.createDataFrame(
        [(r._source, i, n, t) for i, (r, n, t) in enumerate(zip(found, sizes, goal))],
        "_source string, rank int, source_size long, target double"), sum(sizes)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", carry: bool = False, seed: int = SEED) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, shard; with ``carry`` also
    the whole document as ``_row``.

    size is the number of words (null: 0); sources stand by code point, null last and a source
    like any other. ``taken`` is the number of words the mix takes of the document, repeats
    counted, at most three times its size. Documents without words are taken with none.
    Rows that repeat id and text are documents of their own, in any order among themselves. An
    empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    size = F.coalesce(word_count(text), F.lit(0).cast("long"))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
        size.alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), known(text)).alias("_order"),
        *([whole_row(docs)] if carry else []))
    if not carry:
        rows = checkpoint(rows)
    goals, total = source_targets(rows)
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("_order"), F.lit(shards)).cast("int"))
    cells = dealt.groupBy("shard", "_source").agg(F.sum("size").alias("words"))
    cells = cells.join(goals, cells["_source"].eqNullSafe(goals["_source"])).select(
        "shard", "rank", "words", "source_size", "target")
    # Spread over as many tasks as a shuffle has: the cells are small, so they would be
    # brought together in one task otherwise.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    quotas = cells.repartition(n, "shard").groupBy("shard").applyInPandas(
        _quotas, "shard int, rank int, words long, blocks long")
    quotas = quotas.join(goals, "rank").select(
        F.col("shard").alias("_shard"), F.col("_source").alias("_src"), "words", "source_size",
        "target", F.least(F.col("blocks") * BLOCK_WORDS, F.col("words") * MOST_TIMES).alias("_quota"))
    placed = dealt.join(quotas, (F.col("shard") == F.col("_shard"))
                        & F.col("_source").eqNullSafe(F.col("_src")))
    by = Window.partitionBy("shard", "_source").orderBy("_order", "_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("_at", F.sum("size").over(by) - F.col("size"))
    turns = F.floor(F.col("_quota") / F.greatest("words", F.lit(1)))
    rest = F.col("_quota") - turns * F.col("words")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_at")))
    taken = F.when(F.col("size") > 0, turns * F.col("size") + part).otherwise(0)
    return placed.select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        taken.cast("long").alias("taken"), "shard", *(["_row"] if carry else []))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix in whole documents: each row as often as its taken words make up the document.
    All columns are kept, whatever their names. Only the document at which a quota ends is taken in part; it gets
    one copy more with the probability of that part, by a seeded hash of id and text, so that
    a source keeps its words on average, also where documents are longer than the quotas."""
    taken = mix_sources(docs, id_col, text_col, source_col, carry=True)
    own = F.col("_row")
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.lit("rounding"), own[id_col].cast("string"),
                             known(own[text_col])), F.col("size"))
    copies = F.floor((F.col("taken") + draw) / F.col("size")).cast("int")
    kept = taken.filter(F.col("taken") > 0).select("_row", copies.alias("_n")).filter("_n > 0")
    return kept.select("_row", F.explode(F.sequence(F.lit(1), "_n"))).select("_row.*")

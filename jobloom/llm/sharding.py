"""Shards of near-equal bytes: minimax contiguous partition of ordered atomic groups.

Groups of equal texts are the atoms, ordered by a 64-bit hash of the text. The smallest
feasible capacity is found by binary search with a greedy check, exactly, although no list of
all atoms ever leaves the executors: the check runs on sums over hash prefixes, and only the
prefixes in which a cut may fall are resolved further, 64-fold at a time, until each of those
holds one atom.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.llm.words import known
from jobloom.session import checkpoint

OVERHEAD = 8        # bytes a document takes beside its text
FIRST_BITS = 12     # hash prefix of the first look: at most 4096 sums
MORE_BITS = 6       # further bits per look
LAW = "bytes"


def _prefix(bits: int) -> Column:
    """The leading bits of the order hash, in the order of the signed hash."""
    return F.shiftright(F.col("_h"), 64 - bits)


def _summed(atoms: DataFrame, bits: int, among: list[int] | None, parent_bits: int) -> list[tuple]:
    """(first hash, last hash, bytes) of every prefix, in order; bounded by 2**FIRST_BITS or
    by the number of parents times 2**MORE_BITS."""
    if among is not None:
        atoms = atoms.filter(_prefix(parent_bits).isin(among))
    rows = atoms.groupBy(_prefix(bits).alias("p")).agg(
        F.min("_h").alias("a"), F.max("_h").alias("b"), F.sum("_size").alias("s")).collect()
    return sorted((r.a, r.b, int(r.s), bits) for r in rows)


def _greedy(ends: list[int], atomic: list[bool], shards: int, capacity: int,
            inside: bool) -> list[int]:
    """End positions of the shards filled one after another up to ``capacity`` bytes.

    ``inside``: a cut may fall anywhere in a prefix that holds several atoms (no real cut
    reaches further); otherwise only between prefixes (every such cut is a real one).
    """
    cuts, at = [], 0
    for _ in range(shards):
        goal = at + capacity
        i = bisect_right(ends, goal)
        if i == len(ends):
            at = ends[-1]
        elif inside and not atomic[i]:
            at = goal
        else:
            at = max(at, ends[i - 1] if i else 0)
        cuts.append(at)
    return cuts


def _smallest(ends, atomic, shards, inside, low) -> int:
    high = ends[-1]
    while low < high:
        mid = (low + high) // 2
        if _greedy(ends, atomic, shards, mid, inside)[-1] >= ends[-1]:
            high = mid
        else:
            low = mid + 1
    return low


def minimax_cuts(atoms: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity over the ordered atoms (``_h``, ``_size`` > 0), and the
    last hash of every shard but the last, under greedy filling."""
    parts = _summed(atoms, FIRST_BITS, None, 0)
    if not parts:
        return 0, []
    while True:
        ends = list(accumulate(p[2] for p in parts))
        atomic = [p[0] == p[1] for p in parts]
        fair = -(-ends[-1] // shards)
        low = _smallest(ends, atomic, shards, True, fair)
        high = _smallest(ends, atomic, shards, False, low)
        near = _greedy(ends, atomic, shards, low, False)
        far = _greedy(ends, atomic, shards, high, True)
        open_ = set()
        for a, b in zip(near, far):
            i = bisect_left(ends, a)
            while i < len(ends) and (ends[i - 1] if i else 0) <= b:
                if not atomic[i]:
                    open_.add(i)
                i += 1
        if not open_:
            cuts = _greedy(ends, atomic, shards, high, False)
            last = [parts[max(0, bisect_left(ends, c))][1] for c in cuts[:-1]]
            return high, last
        kept = [p for i, p in enumerate(parts) if i not in open_]
        for bits in sorted({parts[i][3] for i in open_}):
            among = [parts[i][0] >> (64 - bits) for i in open_ if parts[i][3] == bits]
            kept += _summed(atoms, min(64, bits + MORE_BITS), among, bits)
        parts = sorted(kept)


def _large_first(atoms: DataFrame, shards: int) -> tuple[list[int], int]:
    """Hashes of the atoms that fill a shard of their own, largest first.

    An atom does when it is at least a fair share of what the larger ones leave; there are
    fewer of them than shards, and they stand before the hashed order.
    """
    total = int(atoms.agg(F.sum("_size")).first()[0] or 0)
    top = atoms.orderBy(F.desc("_size"), "_h").limit(shards).collect()
    large: list[int] = []
    for r in top:
        left = shards - len(large)
        if left > 1 and r._size * left >= total:
            large.append(r._h)
            total -= r._size
        else:
            break
    return large, total


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id",
                    text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard, ``carry``.

    Law ``bytes``: documents of equal text (null counts as empty) share a shard, and the
    largest shard is the smallest that a contiguous cut of the ordered groups allows. Groups
    at or above a fair share stand first and get shards of their own. ``slot`` counts from 0
    in each shard, by (text hash, id). ``grown_shard`` is null under this law. Repeated rows
    are documents of their own; a null id sorts first; an empty table gives no rows; other
    columns are ignored.
    """
    text = known(F.col(text_col))
    rows = checkpoint(docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.struct(*(carry or [F.lit(0)])).alias("_carry")))
    atoms = checkpoint(rows.groupBy("_h").agg(F.sum("size").alias("_size")))
    large, _ = _large_first(atoms, shards)
    rest = atoms.filter(~F.col("_h").isin(large)) if large else atoms
    _, last = minimax_cuts(rest, shards - len(large))
    shard = F.lit(len(large))
    for c in last:
        shard = shard + (F.col("_h") > F.lit(c)).cast("int")
    for i, h in enumerate(large):
        shard = F.when(F.col("_h") == F.lit(h), F.lit(i)).otherwise(shard)
    placed = number_within(rows.withColumn("shard", shard), "shard", ["_h", "_id"])
    return placed.select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
        *[F.col("_carry")[c].alias(c) for c in carry or []])


def number_within(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each group, without gathering a group in one task.

    Rows are range-partitioned by (group, order) and checkpointed; a slot is the place among
    the group's rows in the partition plus its rows in earlier partitions. Only the counts,
    one row per partition and group that meet, are windowed and broadcast.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = checkpoint(rows.repartitionByRange(n, group, *order)
                       .sortWithinPartitions(group, *order))
    placed = fixed.select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    counts = placed.groupBy(group, "_part").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p"))
    return placed.join(F.broadcast(starts), same).select(
        *rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("slot"))

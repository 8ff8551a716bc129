"""Near duplicates: 64-bit SimHash fingerprints, linked by a binary trie joined with itself.

Fingerprints that differ in at most two bits agree in one of three blocks of 21 bits. For
each block the fingerprints are rotated so that the block stands first; those with equal blocks
hang under one node of a binary trie. Pairs of trie nodes are walked down together, from the
pair of that node with itself: the two nodes of a pair stand at one depth, the bits in which
their paths differ are added up, and a pair goes no further when they exceed the budget. A
node pair that holds too many fingerprints for one walk is taken apart into its child pairs in
Spark first, by the same rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.llm.components import components
from jobloom.llm.words import whole_row
from jobloom.session import checkpoint

SHINGLE = 3
SEED = 42
BITS = 64
BLOCK_BITS = 21          # three blocks: some block agrees while at most two bits differ
MAX_DIFFERENT = 2
CELL_ROWS = 4096         # fingerprints under one node pair before Spark takes it apart
CHUNK_ROWS = 1 << 14     # fingerprints walked at a time
STEP_BITS = 4            # trie levels that Spark descends at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included, as a signed 64-bit number; 0 without
    words. Words are split at ASCII white space after lower-casing A-Z."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, h = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [h(joined[a:b], SEED) for a, b in
                  zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")
    # Eight counters in a 64-bit word: exact while at most 255 rows are added up.
    sums = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(bits), 255), axis=0)
    count = sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(bits), bitorder="little").view("<i8")[0])


def fingerprints(text: Column) -> Column:
    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((fingerprint(t.as_py()) for t in batch), pa.int64())

    return run(text.cast("string"))


def walk(prints: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray,
         depth: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of places in ``prints`` that differ in at most ``budget`` bits.

    ``prints`` is unsigned and sorted inside each range. A range lo..hi is one node to pair
    with itself where mid == hi, or two nodes lo..mid and mid..hi; ``depth`` bits are common
    inside each node. All ranges descend together, one bit a turn.
    """
    none = np.zeros(0, np.int64)
    found_i, found_j = [none], [none]
    pair = mid < hi
    used = np.zeros(len(lo), np.int64)
    used[pair] = np.bitwise_count(_top(prints[lo[pair]], depth[pair])
                                  ^ _top(prints[mid[pair]], depth[pair]))
    # Columns: first node, second node (the same one for a self pair), bits used, depth.
    front = np.stack([lo, mid, np.where(pair, mid, lo), hi, used, depth], 1).astype(np.int64)
    front = front[used <= budget]
    for bit in range(int(depth.min(initial=BITS)), BITS):
        front = _settle(prints, front, budget, found_i, found_j)
        if not len(front):
            break
        at = front[:, 5] == bit
        wait, now = front[~at], front[at]
        ones = np.concatenate([[0], np.cumsum((prints >> np.uint64(BITS - 1 - bit)) & np.uint64(1),
                                              dtype=np.int64)])
        a0, a2, b0, b2, used, _ = now.T
        a1, b1 = a2 - (ones[a2] - ones[a0]), b2 - (ones[b2] - ones[b0])
        self_ = a0 == b0
        parts = [(a0, a1, b0, b1, used), (a1, a2, b1, b2, used), (a0, a1, b1, b2, used + 1),
                 (a1[~self_], a2[~self_], b0[~self_], b1[~self_], used[~self_] + 1)]
        new = np.concatenate([np.stack([*p, np.full(len(p[0]), bit + 1)], 1) for p in parts])
        keep = (new[:, 0] < new[:, 1]) & (new[:, 2] < new[:, 3]) & (new[:, 4] <= budget)
        front = np.concatenate([wait, new[keep]])
    _settle(prints, front, budget, found_i, found_j)
    return np.concatenate(found_i), np.concatenate(found_j)


def _settle(prints, front, budget, found_i, found_j) -> np.ndarray:
    """Ends the pairs of two leaves at once: all their remaining bits are compared together."""
    a, b = front[:, 1] - front[:, 0], front[:, 3] - front[:, 2]
    same = front[:, 0] == front[:, 2]
    leaves = (a == 1) & (b == 1) & ~same
    i, j = front[leaves, 0], front[leaves, 2]
    near = np.bitwise_count(prints[i] ^ prints[j]) <= budget
    found_i.append(i[near])
    found_j.append(j[near])
    return front[~leaves & ~(same & (a == 1))]


def _top(prints: np.ndarray, depth: np.ndarray) -> np.ndarray:
    return prints >> (BITS - depth).astype(np.uint64)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, smallest place reachable) for all places that are not their own smallest."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            below = np.flatnonzero(root < np.arange(n))
            return below, root[below]
        root = new


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows (block, depth, p, q, print) of a sorted partition, cut between cells."""
    held, rows = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], 1))
        rows += len(held[-1])
        if rows < CHUNK_ROWS:
            continue
        block = np.concatenate(held)
        cuts = np.flatnonzero((block[1:, :4] != block[:-1, :4]).any(axis=1)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield block[:last]
        held, rows = [block[last:]], len(block) - last
    if rows:
        yield np.concatenate(held)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _chunks(batches):
        cell = np.concatenate([[True], (rows[1:, :4] != rows[:-1, :4]).any(axis=1)])
        lo = np.flatnonzero(cell)
        hi = np.append(lo[1:], len(rows))
        busy = hi - lo > 1
        lo, hi = lo[busy], hi[busy]
        depth, p, q = rows[lo, 1], rows[lo, 2], rows[lo, 3]
        prints = rows[:, 4].view(np.uint64) ^ np.uint64(1 << 63)  # signed order back to bits
        prints = np.ascontiguousarray(prints)
        # The members under p stand before those under q: how many, by the first q.
        under = np.concatenate([[0], np.cumsum(_top(prints, rows[:, 1]) == rows[:, 3].view(
            np.uint64), dtype=np.int64)])
        mid = np.where(p == q, hi, hi - (under[hi] - under[lo]))
        both = (mid > lo) & ((p == q) | (mid < hi))
        i, j = walk(prints, lo[both], mid[both], hi[both], depth[both], MAX_DIFFERENT)
        a, b = _forest(i, j, len(rows))
        turn = (rows[:, 0] * BLOCK_BITS).astype(np.uint64)
        own = (prints >> turn) | np.where(turn > 0, prints << ((BITS - turn) % BITS), 0).astype(
            np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[a].view(np.int64)), pa.array(own[b].view(np.int64))], names=["u", "v"])


def _cells(prints: DataFrame, col: str) -> DataFrame:
    """Rows (block, depth, p, q, r): every fingerprint under its trie node, for each block.

    ``r`` is the rotated fingerprint with its first bit flipped, so that it sorts as unsigned.
    """
    flip = F.lit(-(1 << 63))
    turned = [F.expr(f"shiftleft({col}, {k}) | shiftrightunsigned({col}, {BITS - k})")
              if k else F.col(col) for k in range(0, 3 * BLOCK_BITS, BLOCK_BITS)]
    rows = prints.select(F.posexplode(F.array(*turned)).alias("block", "turned"))
    node = F.shiftrightunsigned("turned", BITS - BLOCK_BITS)
    rows = rows.select("block", F.lit(BLOCK_BITS).alias("depth"), node.alias("p"),
                       node.alias("q"), F.col("turned").bitwiseXOR(flip).alias("r"))
    key = ["block", "depth", "p", "q"]
    done = None
    while True:
        size = rows.groupBy(*key).agg(F.count("*").alias("n"))
        large = checkpoint(size.filter((F.col("n") > CELL_ROWS) & (F.col("depth") < BITS)))
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        calm = rows.join(large, key, "left_anti")
        done = calm if done is None else done.unionByName(calm)
        rows = checkpoint(_children(rows.join(large.drop("n"), key, "left_semi")))


def _children(rows: DataFrame) -> DataFrame:
    """The members of node pairs under the pairs of their nodes' descendants, STEP_BITS down."""
    step = F.least(F.lit(STEP_BITS), F.lit(BITS) - F.col("depth")).cast("int")
    deep = rows.withColumn("step", step).withColumn(
        "raw", F.col("r").bitwiseXOR(F.lit(-(1 << 63))))
    own = F.expr(f"shiftrightunsigned(raw, {BITS} - depth - step)")
    deep = deep.withColumns({"own": own, "parent": F.expr(f"shiftrightunsigned(raw, {BITS} - depth)")})
    other = F.when(F.col("parent") == F.col("p"), F.col("q")).otherwise(F.col("p"))
    deep = deep.withColumn("other", other).withColumn(
        "child", F.explode(F.expr("sequence(0, shiftleft(1, step) - 1)")))
    deep = deep.withColumn("mate", F.expr("shiftleft(other, step) | child")).filter(
        F.bit_count(F.col("own").bitwiseXOR(F.col("mate"))) <= MAX_DIFFERENT)
    return deep.select("block", (F.col("depth") + F.col("step")).alias("depth"),
                       F.least("own", "mate").alias("p"), F.greatest("own", "mate").alias("q"), "r")


def near_links(prints: DataFrame, col: str = "fp") -> DataFrame:
    """Links (u, v) whose components are those of all pairs that differ in at most two bits.

    ``prints`` are distinct. Of the pairs found under one walk only a spanning forest leaves
    the task.
    """
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["block", "depth", "p", "q"]
    cells = _cells(prints, col).repartition(n, *key).sortWithinPartitions(*key, "r")
    return cells.select(*key, "r").mapInArrow(_linked, "u long, v long")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, fp, _k1, _k2 (hashes of id and text), root, component_id, linked of every row."""
    text = F.col(text_col).cast("string")
    written = [F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    rows = checkpoint(docs.select(
        F.col(id_col).alias("_id"), fingerprints(text).alias("fp"),
        F.xxhash64(*written).alias("_k1"), F.hash(*written).alias("_k2")))
    prints = checkpoint(rows.groupBy("fp").agg(F.min("_id").alias("least")))
    roots = components(near_links(prints.select("fp")), "u", "v")
    named = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = named.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("linked"))
    labels = checkpoint(named.select("fp", "root").join(groups, "root"))
    return rows.join(labels, "fp")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id, linked (number of
    different fingerprints in the component).

    component_id is the smallest id reachable over links of at most two differing bits. Null,
    empty and blank texts have fingerprint zero and are linked like any other. Rows that
    repeat are members like any other; a null id is never the smallest unless all are null;
    an empty table gives no rows; other columns are ignored.
    """
    return _grouped(docs, id_col, text_col).select(
        F.col("_id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "linked")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of linked fingerprints: that with the smallest id, as in
    ``simhash_groups``. All columns are kept, whatever their names.

    A null id stands last; of rows that share the smallest id that with the smallest hash
    stays, of rows that also share the text any one. Texts without words are one group. Rows
    that repeat id and text leave one row in every map task before they are shuffled.
    """
    text = F.col(text_col).cast("string")
    written = [F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_k1", "_k2")).alias("first")
    stay = _grouped(docs, id_col, text_col).groupBy("root").agg(first).select(
        "first._k1", "first._k2")
    own = docs.select(whole_row(docs), F.xxhash64(*written).alias("_k1"), F.hash(*written).alias("_k2"))
    same = Window.partitionBy("_k1", "_k2").orderBy("_k1")
    one = own.withColumn("_n", F.row_number().over(same)).filter("_n = 1")
    return one.join(stay, ["_k1", "_k2"], "left_semi").select("_row.*")

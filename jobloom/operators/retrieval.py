"""Exact nearest neighbours, for one query vector or for many at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from jobloom.functions.vectors import euclidean_distance, similarity
from jobloom.session import scratch_path

# Vectors of the queries, and of the corpus, that a task holds at a time.
BLOCK_BYTES = 64 << 20
# One row in so many is measured first, to bound each query's k-th distance.
SAMPLE = 64
# Queries and corpus rows measured together, and candidate pairs measured exactly together.
_BLOCK, _CHUNK, _MEASURED = 256, 2048, 1 << 16


def nearest(vectors: DataFrame, rows: DataFrame, key: str, query: Column, k: int,
            allowed: Column | None = None) -> DataFrame:
    """The k rows nearest to one query vector, ties broken by key.

    Distances are computed on the vector table, so only (key, distance) meets the keys of
    the allowed rows; the wide columns join the k winners alone.
    """
    bound = vectors.select(key, "embedding", query.alias("_query"))
    measured = bound.select(key, euclidean_distance("embedding", "_query").alias("distance"))
    usable = rows if allowed is None else rows.filter(allowed)
    best = (
        measured.join(usable.select(key), key)
        .orderBy(F.col("distance").asc_nulls_last(), F.col(key).asc()).limit(k)
    )
    # k rows at most, so they are broadcast to the wide table.
    return rows.join(F.broadcast(best), key).orderBy("distance", key)


def similar_jobs(vectors: DataFrame, jobs: DataFrame, query: Column, top_k: int = 30) -> DataFrame:
    return nearest(vectors, jobs, "job_id", query, top_k, F.col("title").isNotNull()).select(
        "job_id", "title", "company", "location", "salary_mid", "url", "distance")


def interview_questions(vectors: DataFrame, questions: DataFrame, query: Column,
                        top_k: int = 15) -> DataFrame:
    found = nearest(vectors, questions, "q_id", query, top_k)
    return found.select("q_id", "question", "topic", "source", "distance",
                        similarity("distance").alias("similarity"))


def _matrix(column) -> np.ndarray:
    """An Arrow list column of equal-length vectors as a 2-d array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        raise ValueError("a vector is missing")
    sizes = np.diff(np.asarray(column.offsets))
    if len(sizes) and sizes.min() != sizes.max():
        raise ValueError("vectors differ in length")
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), sizes[0] if len(sizes) else 0)


def _keys(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.to_pylist(), dtype=None if len(column) else object)


def _slack(dim: int, kind) -> float:
    """Bound on the rounding of a fast squared distance, relative to the squared norms."""
    unit = np.finfo(kind).eps
    return (2 * dim + 32) * unit


def _kind(largest: float):
    """The type in which pairs are compared first."""
    return np.float32 if largest < 1e30 else np.float64


def _wide(rows: np.ndarray, square: np.ndarray, kind) -> np.ndarray:
    """Rows with their squared norm and a one beside them, as a matrix product takes them."""
    out = np.empty((len(rows), rows.shape[1] + 2), kind)
    out[:, :-2], out[:, -2], out[:, -1] = rows, square, 1
    return out


class _Block:
    """The k nearest seen so far for each of a few hundred queries."""

    def __init__(self, queries: np.ndarray, k: int, bound: np.ndarray | None = None):
        """``bound``: squared distances that the k nearest are known not to exceed."""
        self.queries, self.k = queries, k
        self.square = (queries.astype(np.float64) ** 2).sum(axis=1)
        self.bound = np.full(len(queries), np.inf) if bound is None else bound.copy()
        self._left: dict = {}
        self._best, self._new, self._held = None, [], 0

    def add(self, keys: np.ndarray, rows: np.ndarray, square: np.ndarray,
            place: np.ndarray | None = None, wide: np.ndarray | None = None) -> None:
        """``rows`` are compared in single precision first, with room for its rounding;
        every pair that may be near enough is then measured in double precision. One matrix
        product tells how far a pair is beyond its query's bound. ``place``: numbers in the
        order of the keys (the keys, if not given); ``wide``: as ``_wide`` makes it."""
        kind = _kind(max(self.square.max(), square.max())) if wide is None else wide.dtype.type
        if wide is None:
            wide = _wide(rows, square, kind)
        if kind not in self._left:
            left = np.empty((len(self.queries), rows.shape[1] + 2), kind)
            left[:, :-2], left[:, -2] = self.queries, 1
            left[:, :-2] *= -2
            self._left[kind] = left
        left = self._left[kind]
        both = self.square + square.max()
        slack = _slack(rows.shape[1], kind) * both + 1e-37
        # No pair is farther apart than twice the sum of the squared norms.
        left[:, -1] = self.square - np.minimum(self.bound, 2.1 * both) - slack
        fast = left @ wide.T
        near = fast <= 0
        if len(rows) > self.k and np.count_nonzero(near) > 2 * self.k * len(fast):
            kth = np.partition(fast, self.k - 1, axis=1)[:, self.k - 1]
            near &= fast <= (kth + 2 * slack)[:, None]
        q, r = np.divmod(np.flatnonzero(near), len(rows))
        place = keys if place is None else place
        for lo in range(0, len(q), _MEASURED):
            step = slice(lo, lo + _MEASURED)
            self._measure(q[step], r[step], keys, place, rows)
        if self._held >= self.k * len(self.queries):
            self._merge()

    def _measure(self, q, r, keys, place, rows) -> None:
        """Exact distances of the candidates; those within the bounds are held."""
        apart = self.queries[q].astype(np.float64) - rows[r]
        square = (apart * apart).sum(axis=1)
        known = square <= self.bound[q]
        q, r = q[known], r[known]
        if len(q):
            self._new.append((q, np.sqrt(square[known]), place[r], keys[r]))
            self._held += len(q)

    def _merge(self) -> None:
        """What is held meets the nearest before it, cut to k per query."""
        if not self._new:
            return
        parts = [*([self._best] if self._best else []), *self._new]
        self._new, self._held = [], 0
        q, d, place, key = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((place, d, q))
        q, d, place, key = q[order], d[order], place[order], key[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < self.k
        self._best = q[kept], d[kept], place[kept], key[kept]
        full = rank == self.k - 1
        # Not below the square that the root was taken of.
        self.bound[q[full]] = np.minimum(
            self.bound[q[full]], np.nextafter(d[full] ** 2 * (1 + 1e-15), np.inf))

    def nearest(self):
        """(query, distance, key) of the nearest, by query, distance and key; None if none."""
        self._merge()
        return self._best and (self._best[0], self._best[1], self._best[3])

    q = property(lambda self: self.nearest()[0])
    key = property(lambda self: self.nearest()[2])


def _output(queries: DataFrame, corpus: DataFrame, query_key: str, key: str) -> T.StructType:
    return T.StructType([
        T.StructField(query_key, queries.schema[query_key].dataType),
        T.StructField(key, corpus.schema[key].dataType),
        T.StructField("distance", T.DoubleType()),
    ])


def _stored(files: list[str], block_bytes: int) -> Iterator[list[pa.Array]]:
    """The columns of stored vectors, a block of rows at a time."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    for file in files:
        store, name = fs.FileSystem.from_uri(file.replace("s3a://", "s3://", 1))
        with store.open_input_file(name) as opened:
            table = pq.ParquetFile(opened)
            rows = table.metadata.num_rows
            width = sum(table.metadata.row_group(i).total_byte_size
                        for i in range(table.num_row_groups)) / max(rows, 1)
            # Keys and vectors of one row are alike in size, so the file tells how many fit.
            step = max(_BLOCK, int(block_bytes / max(width, 1)))
            for batch in table.iter_batches(batch_size=min(step, max(rows, 1))):
                if len(batch):
                    yield batch.columns


def _slabs(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple]:
    """The task's rows as (keys, vectors), some bytes at a time."""
    keys, rows, held = [], [], 0
    for batch in batches:
        matrix = _matrix(batch.column(1))
        if len(matrix):
            keys.append(batch.column(0))
            rows.append(matrix)
            held += matrix.nbytes
        if held >= block_bytes:
            yield pa.concat_arrays(keys), np.concatenate(rows)
            keys, rows, held = [], [], 0
    if rows:
        yield pa.concat_arrays(keys), np.concatenate(rows)


class _Corpus:
    """Corpus rows as the blocks take them, a chunk at a time."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray, place: np.ndarray, largest: float):
        square = (rows.astype(np.float64) ** 2).sum(axis=1)
        self.parts = keys, rows, square, place, _wide(
            rows, square, _kind(max(largest, square.max())))

    def measure(self, blocks: list[_Block]) -> None:
        for at in range(0, len(self.parts[0]), _CHUNK):
            part = [x[at:at + _CHUNK] for x in self.parts]
            for block in blocks:
                block.add(*part)


def _found(block: _Block, keys: pa.Array, at: int, schema: pa.Schema) -> pa.RecordBatch | None:
    """The block's nearest, whose queries begin at a place among the keys."""
    best = block.nearest()
    if best is None:
        return None
    q, d, key = best
    columns = [keys.take(pa.array(q + at)).cast(schema.field(0).type),
               pa.array(key.tolist(), schema.field(1).type), pa.array(d, schema.field(2).type)]
    if len(schema) > 3:
        columns.append(pa.array(np.arange(len(q)) - np.searchsorted(q, q) + 1, schema.field(3).type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _scan(files: list[str], corpus: DataFrame, k: int, out: T.StructType,
          block_bytes: int) -> DataFrame:
    """Every task reads its own part of the corpus in place, and the stored queries block by
    block; each block's nearest leave the task before the next one is opened."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, rows in _slabs(batches, block_bytes):
            order = np.argsort(_keys(names), kind="stable")
            names, rows = _keys(names)[order], rows[order]
            slab = None
            for query_keys, vectors, bounds in _stored(files, block_bytes):
                matrix, bound = _matrix(vectors), bounds.to_numpy()
                largest = (matrix.astype(np.float64) ** 2).sum(axis=1).max()
                if slab is None or _kind(largest) != slab.parts[4].dtype.type:
                    slab = _Corpus(names, rows, np.arange(len(rows)), largest)
                for at in range(0, len(matrix), _BLOCK):
                    best = _Block(matrix[at:at + _BLOCK], k, bound[at:at + _BLOCK])
                    slab.measure([best])
                    found = _found(best, query_keys, at, schema)
                    if found:
                        yield found

    return corpus.mapInArrow(scan, out)


def _scan_by_query(queries: DataFrame, files: list[str], k: int, out: T.StructType,
                   block_bytes: int) -> DataFrame:
    """Every task holds its own queries and reads the stored corpus, which lies in the order of
    its keys, block by block; a query's nearest leave the task complete and ranked."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for query_keys, matrix in _slabs(batches, block_bytes):
            largest = (matrix.astype(np.float64) ** 2).sum(axis=1).max()
            blocks = [_Block(matrix[at:at + _BLOCK], k) for at in range(0, len(matrix), _BLOCK)]
            seen = 0
            for keys, vectors in _stored(files, block_bytes):
                _Corpus(_keys(keys), _matrix(vectors), np.arange(seen, seen + len(keys)),
                        largest).measure(blocks)
                seen += len(keys)
            for i, block in enumerate(blocks):
                found = _found(block, query_keys, i * _BLOCK, schema)
                if found:
                    yield found

    return queries.mapInArrow(scan, out)


def _cut(found: DataFrame, query_key: str, key: str, k: int) -> DataFrame:
    rank = F.row_number().over(
        Window.partitionBy(query_key).orderBy(F.col("distance").asc(), F.col(key).asc()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest_for_all(queries: DataFrame, corpus: DataFrame, query_key: str, key: str,
                    k: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every query its k nearest corpus rows: (query_key, key, distance, rank).

    Pairs are measured as matrix products by tasks that hold a part of one side and read the
    other side from the shared folder in blocks of about ``block_bytes``. Nothing but file names
    passes through the driver, and a task's memory holds one block of queries, with their k
    nearest, and one of the corpus, whatever their numbers. The result is exact; ties are broken
    by key. Rows without a vector are left out on both sides; the keys of queries are unique.
    Executors must reach ``spark.checkpoint.dir`` through Arrow's file systems too.

    Many queries are dealt out, and each meets the whole corpus in one task: its bound tightens
    all the way, and only k rows leave. Few queries (less than a block for every core) are read
    by the tasks that scan the corpus where it lies; a hashed sample of the corpus first bounds
    every query's k-th distance (which can only be farther away there), so that a task hands on
    only what may be among the k nearest of the whole corpus.
    """
    spark = queries.sparkSession
    out = _output(queries, corpus, query_key, key)
    corpus = corpus.select(key, "embedding").filter(F.col("embedding").isNotNull())
    plain, bounded = scratch_path(spark, "queries"), scratch_path(spark, "queries-bounded")
    # Written once: a model may have made them.
    queries.select(query_key, "embedding", F.lit(float("inf")).alias("_bound")).filter(
        F.col("embedding").isNotNull()).write.parquet(plain)
    asked = spark.read.parquet(plain)
    blocks, cores = asked.count() // _BLOCK, spark.sparkContext.defaultParallelism
    if blocks >= cores:
        stored = scratch_path(spark, "corpus")
        corpus.sort(key).write.parquet(stored)
        return _scan_by_query(
            asked.select(query_key, "embedding").repartition(min(blocks, 3 * cores)),
            sorted(spark.read.parquet(stored).inputFiles()), k,
            T.StructType(out.fields + [T.StructField("rank", T.IntegerType())]), block_bytes)
    sample = corpus.filter(F.pmod(F.xxhash64(key), F.lit(SAMPLE)) == 0)
    kth = _cut(_scan(asked.inputFiles(), sample, k, out, block_bytes), query_key, key, k).filter(
        F.col("rank") == k).groupBy(query_key).agg(F.max("distance").alias("_kth"))
    # The square, rounded up: no smaller than that of any distance up to the k-th.
    square = F.col("_kth") * F.col("_kth") * (1 + 1e-15) + F.lit(5e-324)
    asked.join(kth, query_key, "left").select(
        query_key, "embedding", F.coalesce(square, "_bound").alias("_bound")).write.parquet(bounded)
    found = _scan(spark.read.parquet(bounded).inputFiles(), corpus, k, out, block_bytes)
    return _cut(found, query_key, key, k)

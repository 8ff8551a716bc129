"""Benchmark passages in documents, found by suffix arrays over the documents.

A task cuts its documents into shards of bounded size and builds a suffix array of each: the
word positions at which a benchmark window could begin, ordered by the words that follow. Every
benchmark suffix is then binary-searched in it, which gives the range of all places where it
stands verbatim. The benchmark is a stated query set; it is sent in blocks of bounded size, and
passes beyond the first read the result of the pass before, so documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.words import ALNUM_WORD, LOWER, TO_LOWER, UPPER, whole_row

WINDOW = 13              # words of a window; a shorter item is one window
SHARD_WORDS = 1 << 20    # words under one suffix array
BLOCK_CHARS = 1 << 24    # benchmark text broadcast in one block
PASS_BLOCKS = 4          # blocks that one pass over the documents holds

_WORD = re.compile(ALNUM_WORD)
_MATCHES = pa.struct([
    ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ("items", pa.list_(pa.string()))])
_MATCHES_DDL = ("struct<n_words:long,starts:array<long>,ends:array<long>,items:array<string>>")


def split_words(text: str | None) -> list[str]:
    return _WORD.findall(text.translate(TO_LOWER)) if text else []


class Windows:
    """The distinct windows of a block of benchmark items, as rows of word numbers."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.number: dict[str, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in split_words(text)]
            for at in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                found = owners.setdefault(tuple(ids[at:at + WINDOW]), set())
                if item is not None:
                    found.add(item)
        self.owners = [sorted(v) for v in owners.values()]
        self.length = np.array([len(w) for w in owners], np.int64)
        rows = np.zeros((len(owners), WINDOW), ">u4")
        ceil = np.full((len(owners), WINDOW), 0xFFFFFFFF, ">u4")
        for i, w in enumerate(owners):
            rows[i, :len(w)] = ceil[i, :len(w)] = w
        self.low, self.high = _keys(rows), _keys(ceil)
        size = len(self.number) + 2
        self.begins = np.zeros(size, bool)
        self.begins[rows[:, 0].astype(np.int64)] = True
        self.alone = np.zeros(size, bool)
        self.alone[rows[self.length == 1, 0].astype(np.int64)] = True
        self.pairs = np.unique(rows[:, 0].astype(np.int64) * size + rows[:, 1].astype(np.int64))

    @classmethod
    def of(cls, state: dict) -> Windows:
        """The windows with the given attributes. Broadcasts hold plain values, so that
        workers need not import this module."""
        windows = cls.__new__(cls)
        windows.__dict__ = state
        return windows

    def suffix_array(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ordered keys and their positions: all suffixes whose first words begin a window.

        ``ids`` has at least WINDOW zeros behind its last word; zero is a word that no window
        has, so nothing matches across the end of a document.
        """
        at = np.flatnonzero(self.begins[ids])
        pair = ids[at] * len(self.begins) + ids[np.minimum(at + 1, len(ids) - 1)]
        at = at[self.alone[ids[at]] | _member(pair, self.pairs)]
        keys = _keys(ids[at[:, None] + np.arange(WINDOW)].astype(">u4"))
        order = np.argsort(keys, kind="stable")
        return keys[order], at[order]

    def places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence, by binary search of every window."""
        keys, at = self.suffix_array(ids)
        first = np.searchsorted(keys, self.low, "left")
        count = np.searchsorted(keys, self.high, "right") - first
        window = np.repeat(np.arange(len(count)), count)
        rank = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        return at[rank], window


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings that sort as the rows do."""
    return np.ascontiguousarray(rows).view(f"S{4 * WINDOW}").ravel()


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _search(texts: list[str | None], blocks: list[Windows]) -> list[dict]:
    """Merged spans of hit words and the items found, for one shard of texts."""
    split = [split_words(t) for t in texts]
    lengths = np.array([len(w) for w in split], np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    delta = np.zeros(int(begin[-1]) + WINDOW + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for block in blocks:
        ids = np.zeros(len(delta), np.int64)
        get = block.number.get
        for b, words in zip(begin, split):
            ids[b:b + len(words)] = [get(w, 0) for w in words]
        at, window = block.places(ids)
        np.add.at(delta, at, 1)
        np.add.at(delta, at + block.length[window], -1)
        doc = np.searchsorted(begin, at, "right") - 1
        for d, w in np.unique(np.stack([doc, window], 1), axis=0).tolist():
            items[d].update(block.owners[w])
    hit = np.concatenate([[0], (np.cumsum(delta) > 0).astype(np.int8), [0]])
    edges = np.diff(hit)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    low, high = np.searchsorted(starts, begin[:-1]), np.searchsorted(starts, begin[1:])
    return [{"n_words": int(n), "starts": (starts[a:z] - b).tolist(),
             "ends": (ends[a:z] - b).tolist(), "items": list(found)}
            for n, a, z, b, found in zip(lengths, low, high, begin, items)]


def _shards(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts with about SHARD_WORDS words; a longer text is a run of its own."""
    run: list[str | None] = []
    chars = 0
    for t in texts:
        if run and chars + len(t or "") > 6 * SHARD_WORDS:
            yield run
            run, chars = [], 0
        run.append(t)
        chars += len(t or "")
    if run:
        yield run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The benchmark's rows in blocks of at most BLOCK_CHARS characters (or one longer row)."""
    block: list[tuple] = []
    chars = 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for r in rows.toLocalIterator():
        if block and chars + len(r.t or "") > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append((r.i, r.t))
        chars += len(r.t or "")
    yield block


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text",
                 output: str = "matches") -> DataFrame:
    """The documents with ``output``: n_words, starts and ends of the merged stretches of hit
    words (from 0, end exclusive), and the ids of all items with a window in the text.

    Null text has no words; a null item text has no windows; the windows of an item without an
    id hit words but name no item. Repeated rows, of documents or items, give equal rows. All
    columns are kept.
    """
    sc = docs.sparkSession.sparkContext
    sent = [sc.broadcast(vars(Windows(b))) for b in _blocks(benchmark, item_col, item_text_col)]

    def finder(group: list):
        @F.arrow_udf(_MATCHES_DDL)
        def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            blocks = [Windows.of(b.value) for b in group]
            for batch in batches:
                out = [row for run in _shards(batch.to_pylist()) for row in _search(run, blocks)]
                yield pa.array(out, type=_MATCHES)

        return find(F.col(text_col))

    passes = [finder(sent[i:i + PASS_BLOCKS]) for i in range(0, len(sent), PASS_BLOCKS)]
    found = docs.withColumn(output, passes[0])
    for one in passes[1:]:
        # Rare: a benchmark of over PASS_BLOCKS * BLOCK_CHARS characters.
        found = found.withColumn("_more", one)
        found = found.withColumn(output, _merged(F.col(output), F.col("_more"))).drop("_more")
    return found


def _merged(a, b):
    """The union of two match columns: stretches joined where they touch or overlap."""
    def pairs(m):
        return F.transform(F.arrays_zip(m["starts"].alias("s"), m["ends"].alias("e")),
                           lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))

    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))
        return F.when(last.isNotNull() & (x["s"] <= last["e"]), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(x)))

    spans = F.aggregate(F.array_sort(F.concat(pairs(a), pairs(b))),
                        F.array().cast("array<struct<s:long,e:long>>"), add)
    return F.struct(
        a["n_words"].alias("n_words"), F.transform(spans, lambda x: x["s"]).alias("starts"),
        F.transform(spans, lambda x: x["e"]).alias("ends"),
        F.array_union(a["items"], b["items"]).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated,
    longest_match (words of the longest stretch), first_match (its word position; else null).

    A document is contaminated when a twentieth of its words or more is hit. An empty table
    gives no rows; an empty benchmark hits nothing.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t"))
    found = with_matches(rows, benchmark, "_t", item_col, item_text_col, "m").select(id_col, "m")
    length = F.zip_with("m.ends", "m.starts", lambda e, s: e - s)
    found = found.select(
        id_col, F.col("m.n_words").alias("n_words"),
        F.aggregate(length, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("m.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("m.items"), ","), 256).alias("items_sha256"),
        F.coalesce(F.array_max(length), F.lit(0).cast("long")).alias("longest_match"),
        F.get("m.starts", F.array_position(length, F.array_max(length)).cast("int") - 1).alias(
            "first_match"))
    return found.withColumn("contaminated", _is_contaminated(F.col("n_hit"), F.col("n_words")))


def _is_contaminated(hit, total):
    return (hit > 0) & (20 * hit >= total)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their own columns, whatever their names."""
    rows = docs.select(whole_row(docs), F.col(text_col).cast("string").alias("_t"))
    found = with_matches(rows, benchmark, "_t", item_col, item_text_col, "_m")
    hit = F.aggregate(F.zip_with("_m.ends", "_m.starts", lambda e, s: e - s),
                      F.lit(0).cast("long"), lambda a, x: a + x)
    return found.filter(~_is_contaminated(hit, F.col("_m.n_words"))).select("_row.*")


_SQL_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
              f"'{ALNUM_WORD}')")
SQL = f"""
with w as (select doc_id, {_SQL_WORDS} as ws from documents),
b as (select item_id, {_SQL_WORDS} as ws from benchmark),
windows as (
  select distinct item_id, array_to_string(ws[k:k + {WINDOW - 1}], ' ') as win,
    least({WINDOW}, len(ws)) as n
  from (select *, unnest(range(1, greatest(1, len(ws) - {WINDOW - 1}) + 1)) as k from b
        where len(ws) > 0)),
places as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as k from w),
hits as (
  select doc_id, k, p.n, item_id from (
    select doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') as win
    from places, (select distinct n from windows) where k + n - 1 <= len(ws)) p
  join windows using (win) where p.n = windows.n),
hit as (select distinct doc_id, unnest(range(k, k + n)) as pos from hits),
runs as (
  select doc_id, min(pos) as lo, count(*) as size from (
    select doc_id, pos, pos - row_number() over (partition by doc_id order by pos) as run from hit)
  group by doc_id, run),
longest as (
  select doc_id, max(size) as longest_match, min(lo) filter (size = most) - 1 as first_match,
    sum(size) as n_hit
  from (select *, max(size) over (partition by doc_id) as most from runs) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct doc_id, cast(item_id as varchar) as i from hits where item_id is not null)
  group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated,
  cast(coalesce(longest_match, 0) as bigint) as longest_match,
  cast(first_match as bigint) as first_match
from w left join longest using (doc_id) left join items using (doc_id)
"""

"""Alignment of two tokenizers: which tokens of one stand where which of the other do.

Both cut the same bytes. Every token points to its farthest-right overlapping token (itself,
where none ends behind it and it is of the second tokenizer); following the pointers of pointers
doubles the steps at every turn, until all tokens of a component hold its terminal token. The
components, in order, are the groups between bytes at which both tokenizers cut.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from jobloom.llm.tokens import Encoder, _runs, byte_letters, gathered
from jobloom.llm.words import known
from jobloom.operators.encode import once_per_worker
from jobloom.session import checkpoint, scratch_path

FREQUENT = 1 << 20     # id pairs at most that are broadcast with their counts
LONG_GROUP = 1 << 10   # pairs of a group beyond which equal ids are counted before they are paired
BATCH_ROWS = 256       # rows handed on together
RUN_CHARS = 1 << 20    # characters of texts that are aligned together
MEMO_WORDS = 300_000   # words at most whose ids a worker remembers


class Pair:
    """Ids and bytes of both tokenizers' tokens.

    Both cut before a space between visible Latin characters (no piece of the second holds a
    space behind another character), so the words of even texts are encoded once and remembered.
    """

    def __init__(self, byte_path: str, piece_path: str):
        # One thread: the cores are taken by the other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor

        self.first = Encoder(byte_path, special=False, pieces=MEMO_WORDS)
        self.second = SentencePieceProcessor(model_file=piece_path)
        self.memo: dict[str, bytes] = {}
        back = {chr(c): b for b, c in byte_letters().items()}
        vocab = self.first.tokenizer.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            entries[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        n = self.second.get_piece_size()
        pieces = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in enumerate(map(self.second.id_to_piece, range(n)))]
        self.bytes = [pa.array(entries, pa.large_binary()), pa.array(pieces, pa.large_binary())]
        self.sizes = [np.array([len(b) for b in t], np.int64) for t in (entries, pieces)]
        # Written forms of ids with the sign behind them: , and | of the first, , and ; of the second.
        signs = [(len(entries), ","), (len(entries), "|"), (n, ","), (n, ";")]
        self.written = pa.array([f"{i}{s}" for m, s in signs for i in range(m)], pa.large_string())
        self.base = np.cumsum([0, *(m for m, _ in signs)])

    def _second(self, words: list[str]) -> list[bytes]:
        """Ids of words as they stand behind a space."""
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        new = list(set(words).difference(self.memo))
        self.memo.update(zip(new, (np.array(i, "<u4").tobytes()
                                   for i in self.second.encode(new, num_threads=1))))
        return list(map(self.memo.__getitem__, words))

    def _even(self, texts: list[str]) -> list[list[np.ndarray]]:
        words = pc.split_pattern(pa.array(texts, pa.string()), " ")
        coded = words.flatten().dictionary_encode()
        index, different = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        out = []
        for known in (self.first._known(different), self._second(different)):
            ids, ends = gathered(known, index)
            cuts = ends[words.offsets.to_numpy()]
            ids = ids.astype(np.int64)
            out.append([ids[a:z] for a, z in zip(cuts, cuts[1:])])
        return out

    def ids(self, texts: list[str]) -> list[list[np.ndarray]]:
        """Ids of each text behind a space, by the first and by the second tokenizer."""
        even = [self.first._even(t) for t in texts]
        together = self._even([t for t, e in zip(texts, even) if e]) if any(even) else [[], []]
        rest = [t for t, e in zip(texts, even) if not e]
        one = self.first.tokenizer.encode_batch_fast([" " + t for t in rest], add_special_tokens=False)
        alone = [[e.ids for e in one], self.second.encode(rest, num_threads=1)]
        out = []
        for mine, others in zip(map(iter, together), map(iter, alone)):
            out.append([next(mine) if e else np.array(next(others), np.int64) for e in even])
        return out


def _joined(pieces: pa.Array) -> tuple[memoryview, np.ndarray]:
    """All pieces behind each other, and where each begins, and the last ends."""
    _, offsets, data = pieces.buffers()
    return memoryview(data or b"").cast("B"), np.frombuffer(offsets, np.int64, len(pieces) + 1)


def _starts(lists: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *map(len, lists)])


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each token; ``ends`` are the tokens' ends in the same bytes."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the token that holds the last byte reaches farthest
    over_b = np.searchsorted(ends_a, ends_b)
    last = ends_a[over_b] == ends_b           # nothing overlaps it farther right: terminal
    reach = np.concatenate([n + over_a, np.where(last, n + np.arange(len(ends_b)), over_b)])
    while True:
        further = reach[reach]
        if np.array_equal(further, reach):
            break
        reach = further
    number = np.cumsum(last) - 1              # terminals in order
    label = number[reach - n]
    return label[:n], label[n:]


def _pairs(ids: list[np.ndarray], groups: list[np.ndarray], doc: np.ndarray,
           width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, first id * width + second id, links: one entry a document and linked id pair.

    ``doc`` is the document of each group.
    """
    counts = [np.bincount(g, minlength=len(doc)) for g in groups]
    starts = [np.cumsum(c) - c for c in counts]
    long = counts[0] * counts[1] > LONG_GROUP
    a = np.flatnonzero(~long[groups[0]])
    g = groups[0][a]
    times = counts[1][g]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    b = np.repeat(starts[1][g], times) + within
    pair = [np.repeat(ids[0][a], times) * width + ids[1][b]]
    owner, links = [np.repeat(doc[g], times)], [np.ones(len(b), np.int64)]
    for k in np.flatnonzero(long):
        (x, m), (y, n) = (np.unique(i[s[k]:s[k] + c[k]], return_counts=True)
                          for i, s, c in zip(ids, starts, counts))
        pair.append((x[:, None] * width + y).ravel())
        links.append((m[:, None] * n).ravel())
        owner.append(np.full(len(pair[-1]), doc[k]))
    pair, owner, links = map(np.concatenate, (pair, owner, links))
    most = int(pair.max(initial=0)) + 1
    key = owner * most + pair
    if long.any():
        order = np.argsort(key, kind="stable")
        key, first = np.unique(key[order], return_index=True)
        links = np.add.reduceat(links[order], first)
    else:
        key, links = np.unique(key, return_counts=True)
    return key // most, key % most, links


def aligned(tools: Pair, texts: list[str]) -> list[dict]:
    """For each text: n_a, n_b, n_groups, n_links, groups (written), pairs and their links."""
    out = [{"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pairs": [], "links": []}
           for _ in texts]
    at = [k for k, t in enumerate(texts) if t]
    if not at:
        return out
    ids = tools.ids([texts[k] for k in at])
    made = []
    for side, table in zip(ids, tools.bytes):
        flat = np.concatenate(side)
        data, offsets = _joined(table.take(pa.array(flat)))
        made.append((data, offsets[_starts(side)]))
    same = []
    for i, k in enumerate(at):
        want = (" " + texts[k]).encode()
        same.append(all(data[ends[i]:ends[i + 1]] == want for data, ends in made))
    at = [k for k, s in zip(at, same) if s]
    if not at:
        return out
    ids = [[x for x, s in zip(side, same) if s] for side in ids]
    first = [_starts(side) for side in ids]
    flat = [np.concatenate(side) for side in ids]
    ends = [np.cumsum(size[x]) for size, x in zip(tools.sizes, flat)]
    groups = groups_of(*ends)
    n_groups = int(groups[1][-1]) + 1
    count = [np.bincount(g, minlength=n_groups) for g in groups]
    # A document ends with a group, so its groups begin behind those of the last one's tokens.
    cut = np.concatenate([[0], groups[1][first[1][1:] - 1] + 1])
    doc = np.repeat(np.arange(len(at)), np.diff(cut))
    owner, pair, links = _pairs(flat, list(groups), doc, len(tools.sizes[1]))
    of = np.searchsorted(owner, np.arange(len(at) + 1))
    # Tokens of both in the order in which they are written: by group, the first tokenizer's before.
    before = [np.cumsum(c) - c for c in count]
    place_a = np.arange(len(flat[0])) + before[1][groups[0]]
    place_b = np.arange(len(flat[1])) + (before[0] + count[0])[groups[1]]
    last_a = np.append(groups[0][1:] != groups[0][:-1], True)
    last_b = np.append(groups[1][1:] != groups[1][:-1], True)
    key = np.empty(len(flat[0]) + len(flat[1]), np.int64)
    key[place_a] = flat[0] + np.where(last_a, tools.base[1], tools.base[0])
    key[place_b] = flat[1] + np.where(last_b, tools.base[3], tools.base[2])
    text, offsets = _joined(tools.written.take(pa.array(key)))
    cuts = offsets[first[0] + first[1]]
    total = np.add.reduceat(count[0] * count[1], cut[:-1])
    for i, k in enumerate(at):
        out[k] = {"n_a": len(ids[0][i]), "n_b": len(ids[1][i]), "n_groups": int(cut[i + 1] - cut[i]),
                  "n_links": int(total[i]), "groups": str(text[cuts[i]:cuts[i + 1] - 1], "ascii"),
                  "pairs": pair[of[i]:of[i + 1]], "links": links[of[i]:of[i + 1]]}
    return out


OUT = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<long>"


def align_texts(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: the id, n_a, n_b, n_groups, n_links, groups, and the linked id pairs.

    ``groups`` is written as ``a1,a2|b1;a3|b2``; ``pairs`` holds each linked id pair of the text
    once (first id times the second vocabulary's size, plus the second id) and ``links`` how
    many linked token pairs it has. Null and empty texts, and texts whose tokens' bytes are not
    those of the text behind a space, have zeros, empty lists and an empty string. Rows that
    repeat are aligned each; other columns are not carried. Texts are worked on whole, some
    1 MiB at a time or one longer text, whose tokens take some 200 bytes each.
    """
    kind = pa.struct([*[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")],
                      ("groups", pa.string()), ("pairs", pa.list_(pa.int64())),
                      ("links", pa.list_(pa.int64()))])
    cells = docs.select(F.col(id_col), known(F.col(text_col)).alias("_text"))
    named = cells.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = once_per_worker(f"pair {byte_path} {piece_path}", lambda: Pair(byte_path, piece_path))
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for a, z in _runs(texts, RUN_CHARS):
                rows = aligned(tools, texts[a:z])
                for k in range(0, z - a, BATCH_ROWS):
                    found = pa.array(rows[k:k + BATCH_ROWS], kind)
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(a + k, len(found)), *found.flatten()], names=[id_col, *kind.names])

    return cells.mapInArrow(run, f"`{id_col}` {named}, {OUT}")


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """pair, n (rows that hold it), best (no pair of its first id is in more), checkpointed."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    per_id = Window.partitionBy(F.expr(f"pair div {width}"))
    return checkpoint(counts.withColumn("best", F.col("n") == F.max("n").over(per_id)))


def _frequent(counts: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` pairs are in so many rows."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(power.alias("p")).agg(F.count("*")).collect())
    held, least = 0, max(sizes, default=-1) + 1
    while least and held + sizes.get(least - 1, 0) <= most:
        least -= 1
        held += sizes.get(least, 0)
    return 1 << least


def alignment_table(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row the numbers of its alignment, and how common its links are over all rows.

    n_best counts the links whose id pair is in as many rows as any pair of its first id, count_sum
    adds the rows over all links, groups_sha256 is the digest of ``groups`` (empty without tokens).
    The aligned rows are written to the shared folder, so that no text is encoded twice. Pairs in
    many rows meet their counts through a broadcast of at most ``FREQUENT`` pairs; the others, of
    which none is in many rows, in a join. Both sums are exact.
    """
    from sentencepiece import SentencePieceProcessor

    spark = docs.sparkSession
    width = SentencePieceProcessor(model_file=piece_path).get_piece_size()
    path = scratch_path(spark, "aligned")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    align_texts(docs, byte_path, piece_path, id_col, text_col).select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), "n_a", "n_b",
        "n_groups", "n_links", digest.alias("groups_sha256"), "pairs", "links").write.option(
        "compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    counts = pair_counts(rows, width)
    least = _frequent(counts, FREQUENT)
    held = rows.select("_row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(
        "_row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    often = F.broadcast(counts.filter(F.col("n") >= least))
    seldom = counts.filter(F.col("n") < least)

    def summed(found: DataFrame) -> DataFrame:
        return found.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("n")).alias("count_sum"))

    both = summed(held.join(often, "pair")).unionByName(
        summed(held.join(often.select("pair"), "pair", "left_anti").join(seldom, "pair")))
    sums = both.groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return rows.drop("pairs", "links").join(sums, "_row", "left").select(
        F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", none("n_best"),
        none("count_sum"), "groups_sha256")

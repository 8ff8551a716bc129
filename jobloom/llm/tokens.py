"""Token-id files with keyed access.

A file holds the documents of one stretch of ascending ids::

    magic "TOKSEG01" | u32 header length | header JSON | perfect-hash words (u64)
    | fingerprints (u32) | first entry and entry count of each key (u32, u32)
    | key and end offset of each entry (i64, u64) | raw ids (u32, little-endian)

The perfect hash gives a key's slot; the slot holds the key's fingerprint and its entries; the
entry ends cut the raw payload. Files are rows of a Parquet table (``shard``, ``segment``,
``first_key``, ``last_key``, ``n_ids``, ``content``), so that any store Spark writes to will
do, and a lost executor's files are written again by Spark's own committer. The table's key
ranges lead a reader to the file of a key.
"""

from __future__ import annotations

import array
import ctypes
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from jobloom.llm import perfect
from jobloom.llm.words import known
from jobloom.operators.encode import once_per_worker
from jobloom.session import scratch_path

MAGIC = b"TOKSEG01"
END_ID = 2
SEGMENT_IDS = 1 << 19   # a file is closed when it holds so many ids: 2 MiB of payload
RUN_CHARS = 3 << 20     # characters of texts that are encoded together
MEMO_PIECES = 600_000   # pieces at most in a worker's memory

# Between two visible Latin characters a space always opens a new piece of the byte-level
# pre-tokenizer, and merges never cross pieces, so texts may be cut there.
CUT = re.compile("(?<=[!-~À-ɏ])(?= [!-~À-ɏ])")
# Signs beside which a space may be no such cut.
ODD = re.compile("[^\n -~À-ɏ]")
# Before a piece that no space precedes; even texts hold no such character.
FIRST = "\0"

# Latin letters, and visible ASCII signs behind them: two pieces (one without signs). The
# apostrophe is left out, as it may begin a piece with letters.
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[int, int]:
    """The letter under which the byte-level alphabet shows each byte: visible Latin-1 signs
    stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


FILE_SCHEMA = ("shard int, segment int, first_key long, last_key long, n_docs long, "
               "n_ids long, content binary")


def gathered(found: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words ``index`` behind each other, ``found`` holding those of each different
    word; and where each begins, and the last ends."""
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    pool = np.frombuffer(b"".join(found), "<u4")
    length = sizes[index]
    ends = np.concatenate([[0], np.cumsum(length)])
    place = np.repeat((np.cumsum(sizes) - sizes)[index] - ends[:-1], length)
    return pool[place + np.arange(ends[-1])], ends


class Encoder:
    """Ids of texts as little-endian bytes, through the tokenizers library.

    Pieces between safe cuts are encoded once and remembered: those met since the memory was
    last half full, and those of the half before. A text that holds the written form of an
    added token is encoded whole; with ``special`` false such forms are ordinary text.
    """

    def __init__(self, path: str, special: bool = True, pieces: int = MEMO_PIECES):
        # One thread: the cores are taken by the other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added] if special else []
        self.pieces = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.line_end = self._piece("\n")
        # Ids of words that follow a space, and of pieces as they stand behind FIRST.
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most = pieces // 2
        self.space = chr(self.letters[32])

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array("I", e.ids).tobytes() for e in found]

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece of the pre-tokenizer, by the tokenizer's own model."""
        if piece.isascii() and piece[1:].isalpha() and piece[0] == " ":
            shown = self.space + piece[1:]
        else:
            shown = piece.encode().decode("latin-1").translate(self.letters)
        return array.array("I", [t.id for t in self.pieces(shown)]).tobytes()

    def _plain(self, word: str, first: bool) -> bytes | None:
        """Ids of letters and the signs behind them; None for anything else."""
        stem = word.rstrip(SIGNS)
        if not stem.isalpha() or not (stem.isascii() or LATIN.fullmatch(stem)):
            return None
        key = FIRST + stem if first else stem
        found = self.memo.get(key)
        if found is None:
            found = self.memo[key] = self._piece(stem if first else " " + stem)
        if len(stem) == len(word):
            return found
        signs = FIRST + word[len(stem):]
        tail = self.memo.get(signs)
        if tail is None:
            tail = self.memo[signs] = self._piece(signs[1:])
        return found + tail

    def _learn(self, new: set[str]) -> None:
        other = []
        for p in new:
            if "\n" in p or p.startswith(FIRST):
                first = p.startswith(FIRST)
                # A line end between visible signs is a piece of its own.
                head, *lines = p.removeprefix(FIRST).split("\n")
                found = [self._plain(head, first)]
                for line in lines:
                    found += [self.line_end, self._plain(line, True)]
                ids = None if None in found else b"".join(found)
            else:
                ids = self._plain(p, False)
            if ids is None:
                other.append(p)
            else:
                self.memo[p] = ids
        self.memo.update(zip(other, self._encoded(
            [p[1:] if p.startswith(FIRST) else " " + p for p in other])))

    def _known(self, pieces: list[str]) -> list[bytes]:
        if len(self.memo) > self.most:
            self.old, self.memo = self.memo, {}
        found = list(map(self.memo.get, pieces))
        new = {p for p, f in zip(pieces, found) if f is None}
        if not new:
            return found
        if self.old:
            again = new.intersection(self.old)
            self.memo.update((p, self.old[p]) for p in again)
            new -= again
        if new:
            self._learn(new)
        return [self.memo[p] if f is None else f for p, f in zip(pieces, found)]

    def _even(self, text: str) -> bool:
        """Whether every space of the text is a safe cut, and no added token is written in it."""
        return not (
            "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
            or (not text.replace("\n", "").isprintable() if text.isascii() else ODD.search(text))
            or any(s in text for s in self.special))

    def _odd(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._encoded([text])[0]
        return b"".join(self._known([FIRST + p for p in CUT.split(text)]))

    def _split(self, texts: list[str]) -> list[bytes]:
        """Even texts together: their different words are looked up once, and the ids of all
        words are gathered as one array."""
        words = pc.split_pattern(pa.array([FIRST + t for t in texts], pa.string()), " ")
        coded = words.flatten().dictionary_encode()
        ids, ends = gathered(self._known(coded.dictionary.to_pylist()), coded.indices.to_numpy())
        data = ids.tobytes()
        cuts = (4 * ends[words.offsets.to_numpy()]).tolist()
        return [data[a:z] for a, z in zip(cuts, cuts[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        even = [self._even(t) for t in texts]
        together = iter(self._split([t for t, e in zip(texts, even) if e]) if any(even) else [])
        return [next(together) if e else self._odd(t) for t, e in zip(texts, even)]


def _runs(texts: Sequence, most: int = RUN_CHARS,
          size: Callable[..., int] = len) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about ``most`` characters; a longer text is one of its own."""
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars + size(texts[stop]) <= most):
            chars += size(texts[stop])
            stop += 1
        yield at, stop
        at = stop


def give_back() -> None:
    """Memory that this process no longer uses goes back to the system: that of Arrow's pool
    and, where the C library can (glibc), of its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pack(keys: list[int], payloads: list[bytes]) -> bytes:
    """The bytes of one file; ``keys`` ascend and may repeat."""
    distinct, first, count = np.unique(
        np.array(keys, np.int64), return_index=True, return_counts=True)
    sizes, bits = perfect.build(distinct)
    slot = perfect.PerfectHash(sizes, bits)(distinct)
    entries = np.zeros((len(distinct), 2), "<u4")
    entries[slot, 0], entries[slot, 1] = first, count
    prints = np.zeros(len(distinct), "<u4")
    prints[slot] = perfect.fingerprints(distinct)
    ends = np.cumsum([len(p) // 4 for p in payloads]).astype("<u8")
    head = json.dumps({"levels": sizes, "keys": len(distinct), "entries": len(keys)}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, bits.astype("<u8").tobytes(),
                     prints.tobytes(), entries.tobytes(),
                     np.array(keys, "<i8").tobytes(), ends.tobytes(), *payloads])


class TokenFile:
    """Keyed access to the bytes of one file."""

    def __init__(self, content):
        view = memoryview(content)
        if view[:8] != MAGIC:
            raise ValueError("not a token file")
        at = 12 + int.from_bytes(view[8:12], "little")
        head = json.loads(bytes(view[12:at]))
        n, m = head["keys"], head["entries"]

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(view, kind, count, at)
            at += out.nbytes
            return out

        self.hash = perfect.PerfectHash(head["levels"], take("<u8", sum(head["levels"]) // 64))
        self.prints = take("<u4", n)
        self.entries = take("<u4", 2 * n).reshape(n, 2)
        self.keys = take("<i8", m)
        self.ends = take("<u8", m).astype(np.int64)
        self.ids = np.frombuffer(view, "<u4", offset=at)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First entry (-1: absent) and number of entries of each key."""
        keys = np.asarray(keys, np.int64)
        slot = self.hash(keys)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == perfect.fingerprints(keys[ok])
        first = np.where(ok, self.entries[slot, 0] if len(self.entries) else -1, -1).astype(np.int64)
        count = np.where(ok, self.entries[slot, 1] if len(self.entries) else 0, 0).astype(np.int64)
        return first, count

    def span(self, entry: int) -> tuple[int, int]:
        return int(self.ends[entry - 1]) if entry else 0, int(self.ends[entry])

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of every document under the key, end id included; empty if absent."""
        first, count = self.find(np.array([key]))
        spans = [self.span(int(first[0]) + i) for i in range(int(count[0]))]
        return [self.ids[a:b] for a, b in spans]


def segments(batches: Iterator[pa.RecordBatch], encoder: Callable[[list[str]], list[bytes]],
             segment_ids: int = SEGMENT_IDS) -> Iterator[pa.RecordBatch]:
    """Files of the rows (id, text, shard) of a task, one to a batch.

    Only the texts of a run are Python strings at a time, and after each batch unused memory
    goes back to the system: a worker that lives on holds little more than its encoder.
    """
    names = [x.split(" ")[0] for x in FILE_SCHEMA.split(", ")]
    arrow = pa.schema([("shard", pa.int32()), ("segment", pa.int32()),
                       *[(n, pa.int64()) for n in names[2:6]], ("content", pa.binary())])
    end = array.array("I", [END_ID]).tobytes()
    keys, payloads, held, segment, shard = [], [], 0, 0, 0

    def closed() -> pa.RecordBatch:
        row = [shard, segment, keys[0], keys[-1], len(keys), held // 4, pack(keys, payloads)]
        return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=arrow)

    for batch in batches:
        texts = batch.column(1)
        ids, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for a, z in _runs(pc.utf8_length(texts).to_pylist(), RUN_CHARS, int):
            for key, shard, data in zip(
                    ids[a:z], parts[a:z], encoder(texts.slice(a, z - a).to_pylist())):
                keys.append(key)
                payloads.append(data + end)
                held += len(payloads[-1])
                if held >= 4 * segment_ids:
                    yield closed()
                    keys, payloads, held, segment = [], [], 0, segment + 1
        del batch, texts
        give_back()
    if keys:
        yield closed()


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id",
                 text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text and write the files under ``folder``, by ascending id.

    Rows are range-partitioned by (id, text hash) and sorted; a task encodes its rows in order
    and closes a file after ``segment_ids`` ids, so its memory holds one file. Null text
    counts as empty and gives the end id alone. Rows without an id have no key and are not
    written. Rows that repeat an id stand side by side in the order of their text's hash;
    those whose texts are equal too are alike in any order.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = known(F.col(text_col))
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_t"))
    placed = rows.repartitionByRange(n, "_id", "_h").sortWithinPartitions("_id", "_h").select(
        "_id", "_t", F.spark_partition_id().alias("_shard"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_worker(f"tokens {tokenizer_path}", lambda: Encoder(tokenizer_path))
        yield from segments(batches, encoder, segment_ids)

    placed.mapInArrow(encode, FILE_SCHEMA).write.parquet(folder)


def read_tokens(spark, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, shard, segment, entry.

    Each file lists its keys' entries through its own index: the entries found by key must be
    the ones that stand there. ``start`` adds the sizes of the shards before, and of the
    shard's files before; one row per shard and per file takes part in those sums.
    """
    files = spark.read.parquet(folder)
    in_shard = Window.partitionBy("shard").orderBy("segment")
    sizes = files.select("shard", "segment", "n_ids").withColumn(
        "_inside", F.sum("n_ids").over(in_shard) - F.col("n_ids"))
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("_all"))
    shards = shards.select("shard", (F.sum("_all").over(Window.orderBy("shard"))
                                     - F.col("_all")).alias("_before"))
    starts = sizes.join(shards, "shard").select(
        "shard", "segment", (F.col("_inside") + F.col("_before")).alias("_start"))
    out = "doc_id long, at long, n_tokens long, ids_crc32 long, shard int, segment int, entry long"
    names = [x.split(" ")[0] for x in out.split(", ")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, segment, content in zip(*batch.columns):
                file = TokenFile(content.as_buffer())
                keys = np.unique(file.keys)
                first, count = file.find(keys)
                if (first < 0).any() or int(count.sum()) != len(file.ends):
                    raise ValueError("the index does not cover the file")
                entry = np.repeat(first, count) + np.arange(len(file.ends)) - np.repeat(
                    np.cumsum(count) - count, count)
                stop = file.ends[entry]
                at = np.where(entry > 0, file.ends[entry - 1], 0)
                crc = [zlib.crc32(file.ids[a:b]) for a, b in zip(at, stop)]
                n = len(entry)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(keys, count)), pa.array(at), pa.array(stop - at),
                    pa.array(crc, pa.int64()), pa.array(np.full(n, shard.as_py(), np.int32)),
                    pa.array(np.full(n, segment.as_py(), np.int32)), pa.array(entry)], names=names)

    listed = files.select("shard", "segment", "content").mapInArrow(decode, out)
    return listed.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
        "shard", "segment", "entry")


def read_keys(spark, folder: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """key, ids: the token ids of the wanted keys, one row per document found.

    Keys meet the file whose range holds them (a key may stand in more than one file) by the
    ranges of the files, and are looked up there through the perfect hash.
    """
    ranges = spark.read.parquet(folder).select("shard", "segment", "first_key", "last_key")
    wanted = keys.select(F.col(key_col).cast("long").alias("key")).distinct().join(
        ranges, F.col("key").between(F.col("first_key"), F.col("last_key")))
    grouped = wanted.groupBy("shard", "segment").agg(F.collect_list("key").alias("keys"))
    files = spark.read.parquet(folder).select("shard", "segment", "content")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, want in zip(*batch.columns):
                file = TokenFile(content.as_buffer())
                rows = [(k, ids) for k in want.as_py() for ids in file.get(k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in rows], pa.int64()),
                     pa.array([ids.astype(np.int64) for _, ids in rows], pa.list_(pa.int64()))],
                    names=["key", "ids"])

    return files.join(grouped, ["shard", "segment"]).select("content", "keys").mapInArrow(
        look_up, "key long, ids array<long>")


def token_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Write the files to a fresh shared folder and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, tokenizer_path, folder, id_col, text_col)
    return read_tokens(spark, folder)

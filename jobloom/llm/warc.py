"""Web archives: written as whole gzip streams, normalised to one gzip member a record.

``write_archives`` lets Spark write the records of a table of pages as text files that end
every record by the archive format's own separator and are gzipped in one stream: archives of
the monolithic kind. ``normalise`` takes such archives, its own or others': Spark inflates each
stream once, from its start to its end, in pieces between separators; a task joins the pieces
to records by their Content-Length, writes every record as a gzip member of its own and notes
where it lies. The new archives are rows of a Parquet table (``file``, ``content``), so that
any store Spark writes to will do and a lost executor's archives are written again by Spark's
own committer; the sidecar index is a table beside it, in order of record ids.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.llm.words import known
from jobloom.session import checkpoint, scratch_path

LEAST_BYTES = 0            # smaller payloads are never revisits
RECORDS_PER_FILE = 100_000
ARCHIVE_BYTES = 1 << 23    # a normalised archive is closed beyond so many bytes
HOT_SHARE = 1000           # payloads in more than 1 / HOT_SHARE of the rows: fewer than HOT_SHARE
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the archive format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = "record_id string, record_type string, target_uri string, offset long, length long"
ARCHIVES = f"file string, content binary, entries array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>"


def base32(digest: Column) -> Column:
    """Base32 of a SHA-1 digest in hexadecimal digits: eight letters for every five bytes."""
    parts = [F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def paged(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
          uri_col: str = "url", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """id, uri, payload, digest, record_type, refers_to of every row.

    Payloads are equal when length and SHA-256 are. Of equal payloads the row with the largest
    id is the response (rows that repeat that id all are); the others revisit it. Null ids
    come before all others; null payloads are empty. A payload that a great share of the rows
    holds meets its response through a broadcast of fewer than HOT_SHARE rows, every other one
    in a join, where the rows of the former are spread evenly.
    """
    payload = known(F.col(payload_col))
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("rank"),
        F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha1(payload.cast("binary")).alias("sha1"), F.sha2(payload, 256).alias("same"))
    own = F.col("size") < least_bytes
    met = checkpoint(rows.filter(~own).groupBy("same", "size").agg(
        F.count("*").alias("n"), F.max(F.struct("rank", "id")).alias("last")).select(
        "same", "size", "n", F.col("last.id").alias("keep")))
    total = met.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * HOT_SHARE > total
    hot = met.filter(is_hot).select("same", "size", F.lit(True).alias("hot"),
                                    F.col("keep").alias("hot_keep"))
    rest = met.filter(~is_hot).select("same", "size", F.lit(0).alias("spread"), "keep")
    # Rows of hot payloads, and small ones, find no partner under their own spread.
    spread = F.when(F.col("hot") | own, 1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()),
                                                   F.lit(1 << 16))).otherwise(0).cast("int")
    found = rows.join(F.broadcast(hot), ["same", "size"], "left").withColumn(
        "spread", spread).join(rest, ["same", "size", "spread"], "left")
    keep = F.when(own, F.col("id")).when(F.col("hot"), F.col("hot_keep")).otherwise(F.col("keep"))
    first = keep.eqNullSafe(F.col("id"))
    return found.select(
        "id", "uri", "payload", "size", base32(F.col("sha1")).alias("digest"),
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(~first, keep).alias("refers_to"))


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key, F.lit("")), F.lit(">"))


def record_text(date: str = DATE) -> Column:
    """A record of the columns of ``paged``, without the separator behind it."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("size"), F.lit(END))
    block = F.when(F.col("record_type") == "response", F.concat(http, "payload")).otherwise(http)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.regexp_replace("uri", "[\\r\\n]", "")
    revisit = F.concat(line("WARC-Refers-To", _urn(F.col("refers_to"))),
                       line("WARC-Profile", F.lit(PROFILE)))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _urn(F.col("id"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(F.col("record_type") == "revisit", revisit).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block), F.lit(END), block)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id",
                   payload_col: str = "html", uri_col: str = "url",
                   least_bytes: int = LEAST_BYTES, date: str = DATE) -> None:
    """One record a row under ``folder``, in archives that are each one gzip stream."""
    made = paged(pages, id_col, payload_col, uri_col, least_bytes).select(
        record_text(date).alias("value"))
    made.write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def headers(head: bytes) -> dict[str, str]:
    """Fields of a header by lower-cased name; a repeated one keeps its first value."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out.setdefault(name.decode("utf-8", "replace").strip().lower(),
                       value.decode("utf-8", "replace").strip())
    return out


class _Records:
    """Records of one stream from its pieces between separators.

    A payload may end in a part of a separator, so that the stream is split before the record
    ends; the bytes behind a record therefore begin the next one.
    """

    def __init__(self) -> None:
        self.head: bytes | None = None
        self.parts: list[bytes] = []
        self.held = 0
        self.need = 1

    def take(self, piece: bytes) -> Iterator[tuple[bytes, bytes]]:
        """Header and block of every record that the piece completes."""
        end = END.encode()
        self.parts += [piece, end]
        self.held += len(piece) + len(end)
        while self.held >= self.need:
            data = b"".join(self.parts)
            if self.head is None:
                data = data.lstrip(b"\r\n")
                self.head, found, data = data.partition(end)
                if not found:
                    self.head, data = None, self.head
                    self.need = len(data) + 1
                elif not self.head.startswith(b"WARC/"):
                    raise ValueError("a record does not begin with WARC/")
                else:
                    self.need = int(headers(self.head)["content-length"]) + len(end)
            else:
                if not data.startswith(end, self.need - len(end)):
                    raise ValueError("a record is longer than its Content-Length")
                yield self.head, data[:self.need - len(end)]
                self.head, data, self.need = None, data[self.need:], 1
            self.parts, self.held = [data], len(data)

    def close(self) -> None:
        if self.head is not None or self.held:
            raise ValueError("a stream ends within a record")


def member(data: bytes) -> bytes:
    """A gzip member without time or name."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("file", pa.string()), ("content", pa.binary()), ("entries", pa.list_(pa.struct(
        [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
         ("offset", pa.int64()), ("length", pa.int64())])))])
    source, records, segment = None, _Records(), 0
    members: list[bytes] = []
    entries: list[dict] = []
    held = 0

    def closed() -> pa.RecordBatch:
        name = source.rsplit("/", 1)[-1].removesuffix(".gz") + f"-{segment:05d}.warc.gz"
        return pa.RecordBatch.from_pylist(
            [{"file": name, "content": b"".join(members), "entries": entries}], schema=kind)

    for batch in batches:
        for path, piece in zip(*batch.columns):
            if path.as_py() != source:
                records.close()
                if members:
                    yield closed()
                source, segment, members, entries, held = path.as_py(), 0, [], [], 0
            for head, block in records.take(piece.as_py()):
                about = headers(head)
                data = member(b"".join([head, END.encode(), block, END.encode()]))
                entries.append({
                    "record_id": about.get("warc-record-id"), "record_type": about.get("warc-type"),
                    "target_uri": about.get("warc-target-uri"), "offset": held, "length": len(data)})
                members.append(data)
                held += len(data)
                if held >= ARCHIVE_BYTES:
                    yield closed()
                    segment, members, entries, held = segment + 1, [], [], 0
    records.close()
    if members:
        yield closed()


def normalise(spark: SparkSession, source: str, folder: str) -> None:
    """Rewrite the gzipped archives under ``source``: ``folder``/archives and ``folder``/index.

    A stream is read by one task, as gzip demands, in pieces; that task's memory holds one
    record and one new archive. Streams of many members are read alike. A stream that ends
    within a record, or a record that contradicts its Content-Length, fails the job.
    """
    pieces = spark.read.option("lineSep", END).text(source).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))
    pieces.mapInArrow(_normalised, ARCHIVES).write.option("compression", "none").parquet(
        f"{folder}/archives")
    spark.read.parquet(f"{folder}/archives").select("file", F.inline("entries")).repartitionByRange(
        "record_id").sortWithinPartitions("record_id").write.parquet(f"{folder}/index")


def parse(data: bytes) -> dict:
    """Fields of one record: the payload of a response must have the digest it names."""
    head, _, rest = data.partition(END.encode())
    about = headers(head)
    block = rest[:int(about["content-length"])]
    http, _, payload = block.partition(END.encode())
    digest = about.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind = about.get("warc-type")
    size = int(headers(http).get("content-length", len(payload))) if kind == "revisit" else len(payload)
    if kind == "response":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest not in (None, own):
            raise ValueError(f"record {about.get('warc-record-id')} is not what its digest says")
        digest = own
    return {"record_id": about.get("warc-record-id"), "record_type": kind,
            "target_uri": about.get("warc-target-uri"), "refers_to": about.get("warc-refers-to"),
            "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


RECORDS = ("record_id string, record_type string, target_uri string, refers_to string, "
           "payload_bytes long, payload_digest string")
_RECORDS = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
            ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]


def _cut_out(files: DataFrame, payloads: bool) -> DataFrame:
    """Records of the files (content, entries): each member is inflated on its own."""
    kind = pa.schema(_RECORDS + ([("payload", pa.binary())] if payloads else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, entries in zip(*batch.columns):
                view, out, held = memoryview(content.as_buffer()), [], 0
                for e in entries.as_py():
                    data = zlib.decompress(view[e["offset"]:e["offset"] + e["length"]], 31)
                    out.append({n: v for n, v in parse(data).items() if n in kind.names})
                    held += len(data) if payloads else 0
                    if held > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=kind)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=kind)

    return files.select("content", "entries").mapInArrow(
        run, RECORDS + (", payload binary" if payloads else ""))


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of normalised archives; the payload of revisits is null."""
    return _cut_out(spark.read.parquet(f"{folder}/archives"), payloads)


def read_records(spark: SparkSession, folder: str, wanted: DataFrame,
                 record_col: str = "record_id") -> DataFrame:
    """The wanted records alone: the sidecar index names their files and places."""
    keys = wanted.select(F.col(record_col).alias("record_id")).distinct()
    places = spark.read.parquet(f"{folder}/index").join(keys, "record_id").groupBy("file").agg(
        F.collect_list(F.struct("offset", "length")).alias("entries"))
    files = spark.read.parquet(f"{folder}/archives").select("file", "content")
    return _cut_out(files.join(places, "file"), True)


def archived_pages(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                   uri_col: str = "url") -> DataFrame:
    """Write the pages, normalise the archives, and read every record back."""
    spark = pages.sparkSession
    whole, folder = scratch_path(spark, "warc"), scratch_path(spark, "warc-members")
    write_archives(pages, whole, id_col, payload_col, uri_col)
    normalise(spark, whole, folder)
    number = lambda name: F.regexp_extract(name, "^<urn:page:(.+)>$", 1).try_cast(
        pages.schema[id_col].dataType)
    return read_archives(spark, folder, payloads=False).select(
        number("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))


_LETTERS = ", ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(s, {10 * k + 1}, 10))::BIGINT "
    f">> {35 - 5 * j} & 31)::INT, 1)" for k in range(4) for j in range(8))
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS k FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, concat({_LETTERS}) AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM k THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM k THEN k END AS refers_to
FROM g
"""

"""Tables kept as versions over shared bucket files.

A load writes the buckets it changes under a folder of its own; a version is the list of the
pieces (load, bucket) that make up the table. Pieces that a load leaves alone are named again
by the next version and stay where they are, byte for byte:

    root/load=7/bucket=3/part-…    the rows of bucket 3 that load 7 wrote
    root/manifest/version=7        load, bucket, buckets, bytes: the pieces of version 7

In the catalog a version is a partitioned and bucketed table whose partitions are its pieces, so
that Spark reads no other file, prunes by bucket, and joins on the key without a shuffle. A view
of the table's name shows the current version.

The number of buckets belongs to a version. A load that would make buckets larger than
BUCKET_BYTES first doubles it, as often as needed, and deals the stored rows out anew: one task
writes a bucket or reads it for a join, so its share must not grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobloom.schemas import TableSpec
from jobloom.sources.storage import delete, names, size

Piece = tuple[int, int]  # load, bucket
MOST_PIECES = 8          # pieces of a bucket before they are written anew as one
BUCKET_BYTES = 64 << 20  # a bucket's stored bytes and those of a load's rows for it, on average
MOST_BUCKETS = 1 << 16   # Spark takes 100,000 at most


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""
    total = F.lit(0).cast("long")
    for f in df.schema:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            n = F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            n = 8 * F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
        else:
            n = F.lit(8)
        total = total + n
    return total


class BucketTable:
    """One table. ``keep`` versions stay readable, the current one included; ``buckets`` is the
    number of a new table, which grows with it."""

    def __init__(self, spark: SparkSession, database: str, root: str, spec: TableSpec,
                 buckets: int, keep: int):
        self.spark, self.spec, self.root = spark, spec, root
        self.name = f"{database}.{spec.name}"
        self.buckets, self.keep = buckets, keep

    # Storage

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/version={version}"

    def _listed(self, version: int) -> tuple[dict[Piece, int], int]:
        """The bytes of each piece of a version, and its number of buckets. Manifests of before
        hold neither: their number is the one the table was given, and no size is known."""
        rows = self.spark.read.schema("load int, bucket int, buckets int, bytes long").parquet(
            self._manifest(version)).collect()
        return ({(r.load, r.bucket): r.bytes or 0 for r in rows},
                next((r.buckets for r in rows if r.buckets), self.buckets))

    def pieces(self, version: int) -> set[Piece]:
        return set(self._listed(version)[0])

    def versions(self) -> list[int]:
        """Finished versions on storage, ascending."""
        found = [n for n in names(self.spark, f"{self.root}/manifest") if n.startswith("version=")]
        return sorted(int(n[8:]) for n in found
                      if "_SUCCESS" in names(self.spark, f"{self.root}/manifest/{n}"))

    # Catalog

    def _properties(self) -> dict[str, str]:
        return {r["key"]: r["value"]
                for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def version(self) -> int:
        return int(self._properties()["jobloom.version"])

    def number(self) -> int:
        """Buckets of the current version."""
        return int(self._properties().get("jobloom.buckets", self.buckets))

    def store(self, version: int) -> str:
        return f"{self.name}__v{version}"

    def _show(self, version: int, pieces: Iterable[Piece], number: int) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spec.schema)
        store = self.store(version)
        self.spark.sql(f"DROP TABLE IF EXISTS {store}")
        self.spark.sql(
            f"CREATE TABLE {store} ({columns}, load INT, bucket INT) USING parquet "
            f"PARTITIONED BY (load, bucket) CLUSTERED BY ({', '.join(self.spec.key)}) "
            f"INTO {number} BUCKETS LOCATION '{self.root}'")
        parts = " ".join(f"PARTITION (load={load}, bucket={b}) LOCATION "
                         f"'{self.root}/load={load}/bucket={b}'" for load, b in sorted(pieces))
        if parts:
            self.spark.sql(f"ALTER TABLE {store} ADD {parts}")
        shown = ", ".join(f"`{n}`" for n in self.spec.schema.fieldNames())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES "
                       f"('jobloom.version' = '{version}', 'jobloom.buckets' = '{number}') "
                       f"AS SELECT {shown} FROM {store}")

    def ensure(self) -> None:
        """The newest version on storage, or an empty first one, under the table's name."""
        if self.spark.catalog.tableExists(self.name):
            return
        known = self.versions()
        if known:
            self._show(known[-1], *self._listed(known[-1]))
        else:
            self._publish(0, {}, self.buckets)

    def _publish(self, version: int, pieces: dict[Piece, int], number: int,
                 forget: bool = True) -> None:
        rows = [(load, b, number, n) for (load, b), n in sorted(pieces.items())]
        self.spark.createDataFrame(rows, "load int, bucket int, buckets int, bytes long").coalesce(
            1).write.mode("overwrite").parquet(self._manifest(version))
        self._show(version, pieces, number)
        if forget:
            self._forget(version)

    def _forget(self, version: int) -> None:
        """Drop the versions that are no longer kept, and the pieces that only they named."""
        known = self.versions()
        gone = [v for v in known if v <= version - self.keep]
        if not gone:
            return
        held = set().union(*(self.pieces(v) for v in known if v > version - self.keep))
        for v in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.store(v)}")
            old = self.pieces(v) - held
            loads = {load for load, _ in old}
            for load in loads:
                if all(load != other for other, _ in held):
                    delete(self.spark, f"{self.root}/load={load}")
                else:
                    for _, b in (p for p in old if p[0] == load):
                        delete(self.spark, f"{self.root}/load={load}/bucket={b}")
            delete(self.spark, self._manifest(v))

    # Loads

    def bucket_of(self, number: int) -> Column:
        return F.pmod(F.hash(*self.spec.key), F.lit(number))

    def _wanted(self, total: int, number: int) -> int:
        """``number``, doubled until that many buckets hold the bytes."""
        while number * BUCKET_BYTES < total and 2 * number <= MOST_BUCKETS:
            number *= 2
        return number

    def _sized(self, df: DataFrame) -> DataFrame:
        return df.select(*[n for n in self.spec.schema.fieldNames() if n in df.columns])

    def touched(self, stage: DataFrame) -> list[int]:
        """Buckets in which the keys of the stage lie: at most as many numbers as buckets. To be
        asked before ``rows``: the table is given more buckets first, if it will need them."""
        number, rows = self.number(), self._sized(stage)
        found = rows.select(self.bucket_of(number).alias("b"), row_bytes(rows).alias("n")).groupBy(
            "b").agg(F.sum("n").alias("n")).collect()
        now = self._listed(self.version())[0]
        more = self._wanted(sum(now.values()) + sum(r.n for r in found), number)
        if more > number:
            self._grow(more)
        # A key's bucket is the same modulo the number of before.
        return sorted(r.b + at for r in found for at in range(0, more, number))

    def _grow(self, number: int) -> None:
        """The same rows in more buckets, as a version. The versions before stay until the next
        load is done, which may still read them."""
        now = self.version()
        pieces = self._listed(now)[0]
        if pieces:
            pieces = self._write(self.spark.table(self.store(now)), now + 1, number)
        self._publish(now + 1, pieces, number, forget=False)

    def rows(self, buckets: Iterable[int]) -> DataFrame:
        """The current rows of these buckets; no other file is opened."""
        now = self.spark.table(self.store(self.version()))
        return now.filter(F.col("bucket").isin(list(buckets))).drop("load", "bucket")

    def _write(self, df: DataFrame, load: int, number: int) -> dict[Piece, int]:
        """Write rows as the pieces of a load; a bucket is dealt to one task and one file. Keys
        are spread by a hash, so each piece counts for an even part of the load's bytes."""
        path, key = f"{self.root}/load={load}", self.spec.key
        written = f"{self.name}__load{load}"
        self.spark.sql(f"DROP TABLE IF EXISTS {written}")
        (df.select(*self.spec.schema.fieldNames(), self.bucket_of(number).alias("bucket"))
           .repartition(number, *key).write.mode("overwrite").format("parquet")
           .partitionBy("bucket").bucketBy(number, *key).option("path", path)
           .saveAsTable(written))
        self.spark.sql(f"DROP TABLE {written}")  # the files stay
        found = [int(n[7:]) for n in names(self.spark, path) if n.startswith("bucket=")]
        each = size(self.spark, path) // max(1, len(found))
        return {(load, b): each for b in found}

    def replace(self, df: DataFrame) -> None:
        """New rows instead of all; they are read twice, first for their size."""
        n, rows = self.version() + 1, self._sized(df)
        total = rows.agg(F.sum(row_bytes(rows))).first()[0] or 0
        number = self._wanted(total, self.buckets)
        self._publish(n, self._write(df, n, number), number)

    def replace_buckets(self, df: DataFrame, buckets: Iterable[int]) -> None:
        """New rows of these buckets; the files of all others are named again."""
        now, gone = self.version(), set(buckets)
        if gone:
            pieces, number = self._listed(now)[0], self.number()
            new = self._write(df, now + 1, number)
            self._publish(now + 1, {p: n for p, n in pieces.items() if p[1] not in gone} | new, number)

    def append(self, df: DataFrame) -> None:
        """Further rows; no file of the table is read or written anew. Nothing to add leaves
        the version as it is. Buckets of too many pieces are then made one."""
        now, number = self.version(), self.number()
        new = self._write(df, now + 1, number)
        if not new:
            return
        self._publish(now + 1, self._listed(now)[0] | new, number)
        self.compact()

    def compact(self, most: int = MOST_PIECES) -> None:
        """Write buckets of more than ``most`` pieces anew, each as one."""
        pieces: dict[int, int] = {}
        for _, b in self.pieces(self.version()):
            pieces[b] = pieces.get(b, 0) + 1
        busy = [b for b, n in pieces.items() if n > most]
        self.replace_buckets(self.rows(busy), busy)

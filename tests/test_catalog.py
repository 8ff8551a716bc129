"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from jobloom.sources import tables, versions
from tests.check_catalog import connect, difference, spark_table, sql_table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    got = spark_table(entry.queries()[name](spark, FOLDER))
    sql = entry.oracle_sql().get(name)
    if sql:
        assert difference(got, sql_table(con, sql)) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 150


def test_rows_of_given_ids_are_whole(spark):
    """Every skill row of the given ids is counted, under its id."""
    read = {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("orders", "lineitem")}
    given = read["orders"].filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = read["lineitem"].join(given, "l_orderkey", "left_semi").count()
    got = entry.queries()["c18_rows_of_given_ids"](spark, FOLDER)
    assert got.columns == ["job_id", "skill", "rows"]
    assert got.agg(F.sum("rows")).first()[0] == rows


def test_a_task_of_a_counted_load_has_a_bound(spark, monkeypatch):
    """Buckets, which one task reads and writes, stay small however large the table is."""
    folder, name, used = "/root/testdata/sf0.01", "e5_counts_kept_by_loads", []

    class Kept(tables.Warehouse):
        def __init__(self, *args, **options):
            super().__init__(*args, **options)
            used.append(self)

    monkeypatch.setattr(tables, "Warehouse", Kept)
    monkeypatch.setattr(versions, "BUCKET_BYTES", 100_000, raising=False)
    got = spark_table(entry.queries()[name](spark, folder))
    assert difference(got, sql_table(connect(folder), entry.oracle_sql()[name])) is None
    store = used[0].stores["jobs"]
    for v in store.versions():  # of both loads
        found = spark.table(store.store(v)).groupBy("bucket").agg(
            F.sum(F.octet_length("description")).alias("n"), F.count("*").alias("rows")).collect()
        assert sum(r.rows for r in found) == 1000
        assert max(r.n for r in found) < 300_000

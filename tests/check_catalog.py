"""Run every registered query beside its SQL on one folder of tables and compare the rows.

    python tests/check_catalog.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if v is not None and type(v).__name__ == "Decimal":
        return float(v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(con, sql):
    cur = con.execute(sql)
    return table([d[0] for d in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import local_session

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(folder)
    oracle, failed = entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if args[1:] and not any(name.startswith(a) for a in args[1:]):
            continue
        start = time.time()
        try:
            got = spark_table(run(spark, folder))
            took = time.time() - start
            start = time.time()
            note = "rows only" if name not in oracle else difference(
                got, sql_table(con, oracle[name]))
            status = "ok" if note in (None, "rows only") else "DIFF"
            print(f"{status:5}{name:34}{len(got[1]):8} rows {took:7.2f}s sql "
                  f"{time.time() - start:6.2f}s {note or ''}", flush=True)
        except Exception as e:  # noqa: BLE001
            status = "FAIL"
            print(f"FAIL {name}: {str(e)[:700]}", flush=True)
        if status != "ok":
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

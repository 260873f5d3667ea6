"""Run queries next to their SQL in DuckDB and compare whole results.

    python tests/oracle_check.py [sf] [name-part ...]

GROUP_ROWS=100 in the environment makes every larger key take the split paths.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, float):
        return ("f", "nan" if v != v else repr(v + 0.0))
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(plain(x) for x in v))
    return ("s", str(v))


def rows_of(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    t = time.time()
    df = fn(spark, sf_dir)
    cols = df.columns
    got = rows_of(cols, [tuple(r) for r in df.collect()])
    took = time.time() - t
    if sql is None:
        return True, f"rows-only {len(got)} {took:.1f}s"
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = rows_of(want_cols, cur.fetchall())
    if sorted(cols) != sorted(want_cols):
        return False, f"columns {sorted(cols)} vs {sorted(want_cols)}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return False, f"rows {len(got)} vs {len(want)}; differing: {sorted(cols)} {bad}"
    return True, f"ok {len(got)} {took:.1f}s"


def main() -> None:
    import __spark_entry__ as entry
    from millrace.session import local_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("GROUP_ROWS"):  # force the split paths of the ordered operators
        spark.conf.set("spark.millrace.maxGroupRows", os.environ["GROUP_ROWS"])
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if len(args) > 1 and not any(a in name for a in args[1:]):
            continue
        try:
            ok, note = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001 - report every query
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        failed += not ok
        print(("PASS " if ok else "FAIL ") + name, note, flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()

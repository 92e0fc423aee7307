"""Runs registered queries beside their SQL on DuckDB and compares the rows.

    python -m workload.check [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows: list) -> list[tuple]:
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=lambda t: tuple((v is None, str(v)) for v in t))


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[bool, str]:
    from workload import all_queries

    fn, sql = all_queries()[0][name], all_queries()[1].get(name)
    t = time.perf_counter()
    df = fn(spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.perf_counter() - t
    if sql is None:
        return True, f"{took:6.2f}s rows={len(mine)} (no SQL)"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    if mine != theirs:
        gap = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
        bad = sum(a != b for a, b in zip(mine, theirs))
        return False, f"rows {len(mine)} vs {len(theirs)}, {bad} differ, first {gap}"[:900]
    types = [(n, str(t)) for n, t in zip(names, [d[1] for d in result.description])]
    return True, f"{took:6.2f}s rows={len(mine)}" + ("" if mine else " EMPTY") + (" " + str(types) if "-v" in sys.argv else "")


def main() -> int:
    from workload import all_queries

    args = [a for a in sys.argv[1:] if not a.startswith("-")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in all_queries()[0]:
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            good, note = compare(spark, con, sf_dir, name)
        except Exception as problem:
            good, note = False, f"{type(problem).__name__}: {problem}"[:1200]
        print(("ok   " if good else "FAIL ") + f"{name:32s} {note}", flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())

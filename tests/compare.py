"""Run registered queries against their SQL and compare whole results."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and v == 0:
        return 0.0
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def type_difference(df, con, sql: str) -> str | None:
    want = {r[0]: r[1] for r in con.execute("describe " + sql).fetchall()}
    bad = {c: (t, want.get(c)) for c, t in df.dtypes if KINDS.get(t) != want.get(c)}
    return f"types differ: {bad}" if bad else None


def normalise(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(df, names, rows) -> str | None:
    """None if equal, else a short text."""
    got_names, got = normalise(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = normalise(names, rows)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    failed = 0
    for key, run in entry.queries().items():
        if only and key not in only:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if key in sql:
                text = (difference(df, *sql_rows(con, sql[key]))
                        or type_difference(df, con, sql[key]) or "ok")
            else:
                text = f"rows only: {len(df.collect())}"
        except Exception as exc:
            text = f"ERROR {type(exc).__name__}: {str(exc)[:700]}"
        failed += text.startswith(("ERROR", "columns")) or "differ" in text or "!=" in text
        print(f"{key:24s} {time.time() - start:6.2f}s {text}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()

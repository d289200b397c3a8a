"""Runs catalogue queries beside their SQL in DuckDB and compares the results."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

DATA = os.environ.get("CIVICPANEL_DATA", "/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def kind(name: str) -> str:
    name = name.lower()
    if name in ("tinyint", "smallint", "int", "integer", "bigint"):
        return "bigint" if name == "bigint" else "integer"
    return {"varchar": "string", "timestamp_ntz": "timestamp"}.get(name, name)


def compare(spark, con, build, sql: str, folder: str) -> str | None:
    """``None`` when equal, else what differs."""
    df = build(spark, folder)
    cursor = con.execute(sql)
    names = [item[0] for item in cursor.description]
    types = {item[0]: kind(str(item[1])) for item in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = {name: kind(dtype) for name, dtype in df.dtypes}
    if ours != types:
        return f"types differ: {[(n, ours[n], types[n]) for n in names if ours[n] != types[n]]}"
    order = sorted(names)
    got = Counter(tuple(plain(row[n]) for n in order) for row in df.collect())
    index = [names.index(n) for n in order]
    want = Counter(tuple(plain(row[i]) for i in index) for row in expected)
    if got == want:
        return None
    extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}\n  columns {order}\n"
        f"  only spark {extra}\n  only sql {lacking}"
    )


def main(argv: list[str]) -> int:
    from civicpanel.catalogue import ORACLES, QUERIES
    from civicpanel.session import build_session

    scale = os.environ.get("SCALE", "sf0.01")
    folder = f"{DATA}/{scale}"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failures = 0
    for name in argv or list(QUERIES):
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, QUERIES[name], ORACLES[name], folder)
            else:
                problem = None if QUERIES[name](spark, folder).collect() is not None else "none"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures of {len(argv or QUERIES)}")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

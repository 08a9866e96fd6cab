"""Compare queries with their SQL: ``python -m checks.run [-d DIR] [name ...]``."""

from __future__ import annotations

import argparse
import math
import os
import time

import duckdb

from checks import load_all
from checks.registry import ORACLES, QUERIES
from clipsense.session import build_session, clean_up

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v).__name__ == "str"), v if v is not None else 0) for v in row))


def differences(spark, connection, name: str, sf_dir: str) -> str | None:
    """None if both engines agree, else what differs first."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if name not in ORACLES:
        return None if ours else "no rows"
    result = connection.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} / {other}"
    kinds = [{type(v) for row in side for v in row} - {type(None)} for side in (ours, theirs)]
    if kinds[0] != kinds[1]:
        return f"types {kinds}"
    return None if ours else "no rows on either side"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("-d", "--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    arguments = parser.parse_args()
    load_all()
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(arguments.dir)
    failed = 0
    for name in arguments.names or QUERIES:
        start = time.time()
        try:
            found = differences(spark, connection, name, arguments.dir)
        except Exception as error:  # the run goes on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        mark = "ok  " if found is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {'' if name in ORACLES else '(rows)'} {found or ''}", flush=True)
    print(f"{failed} failed")
    clean_up(spark)
    spark.stop()


if __name__ == "__main__":
    main()

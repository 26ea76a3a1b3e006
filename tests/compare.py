"""Run queries next to their SQL and compare rows, whatever their order."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else f"{type(value).__name__}:{value}"


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], cells


def spark_rows(spark, name: str, sf_dir: str):
    df = contract.queries()[name](spark, sf_dir)
    return canonical(df.columns, df.collect())


def duckdb_rows(con, name: str):
    result = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    return canonical(columns, result.fetchall())


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else a short account of how they differ."""
    columns, rows = spark_rows(spark, name, sf_dir)
    if name not in contract.oracle_sql():
        return None if rows else "no rows"
    want_columns, want = duckdb_rows(con, name)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if rows == want:
        return None
    ours, theirs = set(rows) - set(want), set(want) - set(rows)
    return (
        f"{len(rows)} rows, expected {len(want)};"
        f" only here {sorted(ours)[:2]}; only there {sorted(theirs)[:2]}"
    )


if __name__ == "__main__":
    from sensorspan.config import session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    names = sys.argv[1:] or list(contract.queries())
    bad = 0
    for name in names:
        start = time.perf_counter()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        if found:
            bad += 1
        print(f"{time.perf_counter() - start:6.2f}s {name}: {found or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")

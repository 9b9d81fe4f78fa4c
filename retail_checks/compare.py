"""Run queries next to their SQL on DuckDB and compare rows as multisets.

    python -m retail_checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (pd.Timestamp, datetime)):
        return str(value)
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides hold the same columns and rows, else what differs."""
    expected = con.execute(sql)
    columns = [d[0] for d in expected.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    left, right = _rows(result.columns, result.collect()), _rows(columns, expected.fetchall())
    if left == right:
        return None
    return f"{list((left - right).items())[:2]} != {list((right - left).items())[:2]}"


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from retail_checks.oracles import ORACLES
    from retail_checks.queries import QUERIES

    sf_dir, wanted = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="compare-"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        result = QUERIES[name](spark, sf_dir)
        wrong = differences(result, con, ORACLES[name])
        failed += wrong is not None
        n = con.execute(f"select count(*) from ({ORACLES[name]})").fetchone()[0]
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name:36} {time.time() - start:6.1f}s"
              f" {n:8} rows {wrong or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} match")


if __name__ == "__main__":
    main()

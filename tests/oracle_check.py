"""Run registered queries beside their SQL and compare the rows.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value


def plain_rows(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, key: str, sf_dir: str) -> str:
    """'' when equal, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    found = queries()[key](spark, sf_dir)
    ours = plain_rows(found.columns, [tuple(r) for r in found.collect()])
    if key not in oracle_sql():
        return "" if ours else "no rows"
    cursor = con.execute(oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    theirs = plain_rows(names, cursor.fetchall())
    if sorted(found.columns) != sorted(names):
        return f"columns {sorted(found.columns)} and {sorted(names)}"
    if ours == theirs:
        return ""
    mine, other = [r for r in ours if r not in theirs][:3], [r for r in theirs if r not in ours][:3]
    return f"{len(ours)} and {len(theirs)} rows; only Spark {mine}; only SQL {other}"


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            differs = compare(spark, con, key, sf_dir)
        except Exception as err:  # noqa: BLE001 - every key is reported
            differs = f"{type(err).__name__}: {str(err)[:600]}"
        bad += bool(differs)
        kind = "sql" if key in oracle_sql() else "rows"
        print(f"{'FAIL' if differs else 'ok  '} {kind} {key} {time.time() - start:.1f}s {differs}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} ok")


if __name__ == "__main__":
    main()

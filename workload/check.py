"""Compare queries with their SQL on one scale folder: ``python -m workload.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = canonical(df.columns, df.collect())
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = canonical(columns, found.fetchall())
    if ours == theirs:
        return None
    mine, yours = set(ours) - set(theirs), set(theirs) - set(ours)
    return f"{len(ours)} rows against {len(theirs)}; only here {sorted(mine)[:2]}; only there {sorted(yours)[:2]}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        begin = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception:
            problem = traceback.format_exc()[-1500:]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()

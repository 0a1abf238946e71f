"""A query against its SQL over one scale folder."""

from pathlib import Path

import duckdb

from readmill.llm.queries import ORACLE, QUERIES
from workload.check import canonical


def difference(spark, name, sf_dir):
    """(rows, rows only in Spark's result, rows only in SQL's)."""
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / table}.parquet'")
    df = QUERIES[name](spark, str(sf_dir))
    ours = canonical(df.columns, df.collect())
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    theirs = canonical(columns, found.fetchall())
    if ours == theirs:
        return len(ours), [], []
    return len(ours), sorted(set(ours) - set(theirs))[:3], sorted(set(theirs) - set(ours))[:3]

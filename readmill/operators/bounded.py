"""Size checks for dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row

# Rows that may become literals of a plan, and rows that may be broadcast.
MAX_LITERAL_ROWS = 256
MAX_BROADCAST_ROWS = 100_000


def small_rows(df: DataFrame, limit: int = MAX_LITERAL_ROWS) -> list[Row] | None:
    """The rows when there are at most ``limit``, else None. Reads ``limit + 1`` rows."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def fits(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a dimension of short rows is small enough to broadcast."""
    return df.limit(limit + 1).count() <= limit

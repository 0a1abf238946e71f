"""Latest and earliest row per key.

``max_by`` / ``min_by`` combine on the map side, so a hot key costs one row per
task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARRIVAL = ("partition", "offset")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The last row by arrival for every key; null keys form one group."""
    return _one_per_key(df, keys, order, F.max_by)


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL
) -> DataFrame:
    return _one_per_key(df, keys, order, F.min_by)


def _one_per_key(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    picked = df.groupBy(*keys).agg(chosen)
    by_name = {c: F.col(c) for c in keys} | {c: F.col(f"_row.`{c}`").alias(c) for c in rest}
    return picked.select(*[by_name[c] for c in df.columns])


def coalesce_messages(messages: DataFrame, mode: str) -> DataFrame:
    """Strict form: last message per message key, before decoding.

    A malformed last message then hides earlier good ones, and all messages without
    a key collapse into one. Append topics keep every message.
    """
    if mode != "upsert":
        return messages
    return latest_per_key(messages, ["topic", "key"])

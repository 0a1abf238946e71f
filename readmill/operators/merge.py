"""Upsert and append-ignore as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last arrival wins: rows of ``batch`` replace the target's, whatever their event time.

    ``batch`` has one row per key. Only its columns are set; columns found in the
    target alone keep their value. Untouched target rows are only passed through an
    anti-join against the batch's keys, so a small batch does not shuffle the target.
    """
    keys = list(keys)
    kept = [c for c in target.columns if c not in batch.columns]
    touched = batch.select(*keys)
    fresh = batch
    if kept:
        fresh = batch.join(existing(target.select(*keys, *kept), touched, keys), keys, "left")
    untouched = target.join(touched, keys, "left_anti")
    return untouched.unionByName(fresh, allowMissingColumns=True).select(
        *target.columns, *[c for c in batch.columns if c not in target.columns]
    )


def existing(target: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in ``wanted``: the smaller side is the build side."""
    return target.join(wanted, list(keys), "left_semi")


def append_new(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key the target does not hold yet (first arrival wins).

    The target is reduced to the batch's own keys first, so what is shuffled after
    that is at most as large as the batch.
    """
    keys = list(keys)
    hits = existing(target.select(*keys), batch.select(*keys), keys)
    return batch.join(hits, keys, "left_anti")


def merge_into(batch: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table whose format supports MERGE.

    Columns only the table has keep their value.
    """
    match = " and ".join(f"target.`{k}` = source.`{k}`" for k in keys)
    view = f"merge_source_{abs(hash((table, tuple(batch.columns))))}"
    batch.createOrReplaceTempView(view)
    updates = ", ".join(f"target.`{c}` = source.`{c}`" for c in batch.columns if c not in keys)
    names = ", ".join(f"`{c}`" for c in batch.columns)
    values = ", ".join(f"source.`{c}`" for c in batch.columns)
    batch.sparkSession.sql(
        f"MERGE INTO {table} AS target USING {view} AS source ON {match} "
        f"WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )

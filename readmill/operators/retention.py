"""Age limits of read-model tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.plans.projections import Projection


def expired(time_column: str, hours: int | None, as_of: Column) -> Column:
    """Strictly older than the limit. NULL times never expire; 0 or None is no limit."""
    if not hours:
        return F.lit(False)
    cutoff = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return F.coalesce(F.col(time_column) < cutoff, F.lit(False))


def prune(df: DataFrame, time_column: str, hours: int | None, as_of: Column) -> DataFrame:
    """Rows that stay.

    Written as a plain predicate on the column so that file and partition statistics
    can be used by the scan.
    """
    if not hours:
        return df
    cutoff = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.filter(F.col(time_column).isNull() | (F.col(time_column) >= cutoff))


def pruned_counts(df: DataFrame, time_column: str, hours: int | None, as_of: Column) -> DataFrame:
    """One row: rows kept and rows pruned."""
    gone = expired(time_column, hours, as_of)
    return df.agg(
        F.count_if(~gone).alias("kept"),
        F.count_if(gone).alias("pruned"),
    )


def prune_target(projection: Projection) -> tuple[str, int | None]:
    """(time column, hours) the prune job uses for a table."""
    if projection.mode == "append":
        return "time", projection.retention_hours
    return "updated_at", projection.asset_ttl_hours


def resolve_ttl(
    projections: Iterable[Projection], override: int | None = None
) -> list[Projection]:
    """Apply a site-wide TTL to every upsert projection; 0 turns their TTL off.

    Append retention is never touched.
    """
    if override is None:
        return list(projections)
    ttl = override if override > 0 else None
    return [replace(p, asset_ttl_hours=ttl) if p.mode == "upsert" else p for p in projections]


def parse_ttl_override(text: str | None) -> int | None:
    """Setting text: unset or blank means no override."""
    clean = (text or "").strip()
    return int(clean) if clean else None


def effective_hours(mode: Column, retention: Column, ttl: Column, override: Column) -> Column:
    """The same rule over a table of projection settings."""
    overridden = F.when(override > 0, override)
    per_mode = F.when(mode == "upsert", F.when(override.isNull(), ttl).otherwise(overridden)).otherwise(
        retention
    )
    return F.nullif(per_mode, F.lit(0))

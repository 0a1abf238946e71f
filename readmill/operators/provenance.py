"""Origin (edge, region) of a row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.functions import variants as V
from readmill.functions.variants import Field
from readmill.operators.assignment import Asset, Strategy, with_fallback

# Origin of a site that has not been told its own.
SITE_DEFAULTS = ("edge-01", "region-01")


def message_pair(block: Field) -> tuple[Column, Column]:
    """Origin stamped on the message; NULL where blank or missing."""
    return (
        V.truthy_text(block / "edge_id"),
        V.truthy_text(block / "region_id"),
    )


def fieldwise(
    edge: Column, region: Column, defaults: tuple[str, str] = SITE_DEFAULTS
) -> tuple[Column, Column, Column]:
    """Edge and region fall back independently; third: whether either did."""
    return (
        F.coalesce(edge, F.lit(defaults[0])),
        F.coalesce(region, F.lit(defaults[1])),
        edge.isNull() | region.isNull(),
    )


@dataclass(frozen=True)
class Resolver:
    """How rows get their origin: site defaults, and a strategy that decides every row."""

    strategy: Strategy = with_fallback(None)
    defaults: tuple[str, str] = SITE_DEFAULTS


def pair_or_derive(
    df: DataFrame, edge: str, region: str, asset: Asset, strategy: Strategy, out: str
) -> DataFrame:
    """Struct ``out`` (edge_id, region_id): the message's pair when complete, else derived.

    The two sources are never mixed. Rows with a complete pair reach the strategy with
    NULL inputs, which match nothing and are dealt out evenly in joins.
    """
    complete = F.col(edge).isNotNull() & F.col(region).isNotNull()
    names = ("_for_id", "_for_lat", "_for_lon")
    masked = df.withColumns(
        {n: F.when(~complete, F.col(c)) for n, c in zip(names, (asset.asset_id, asset.lat, asset.lon))}
    )
    derived = strategy(masked, Asset(*names), "_derived")
    chosen = F.when(
        complete, F.struct(F.col(edge).alias("edge_id"), F.col(region).alias("region_id"))
    ).otherwise(
        F.struct(F.col("_derived.edge_id").alias("edge_id"), F.col("_derived.region_id").alias("region_id"))
    )
    return derived.withColumn(out, chosen).drop("_derived", *names)

"""One row per nested entry of a read-model blob."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmill.functions import variants as V


def _entries(rows: DataFrame, blob: str, keep: list[str]) -> DataFrame:
    entries = F.try_variant_get(F.col(blob), "$", "array<variant>")
    return rows.select(*keep, F.posexplode(entries).alias("position", "entry"))


def explode_elements(rows: DataFrame) -> DataFrame:
    """Elements of asset element telemetry with their declared fields."""
    entry = F.col("entry")
    typed = {
        "element_id": "string", "layer_depth": "bigint", "layer_name": "string",
        "health": "string", "temp_c": "double", "load_pct": "double",
        "tx_active": "boolean", "rx_active": "boolean",
    }
    return _entries(rows, "elements", ["asset_id"]).select(
        "asset_id", "position",
        *[F.try_variant_get(entry, f"$.{n}", kind).alias(n) for n, kind in typed.items()],
    )


def explode_capabilities(rows: DataFrame) -> DataFrame:
    """Capabilities of an asset, each kept as a VARIANT."""
    return _entries(rows, "capabilities", ["asset_id"]).select(
        "asset_id", "position", F.when(V.is_present(V.field(F.col("entry"))), F.col("entry")).alias("capability")
    )

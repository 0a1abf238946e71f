"""Field mappings shared by the projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from readmill.functions import variants as V
from readmill.functions.variants import Field

# Severity keys in priority order.
SEVERITY_KEYS = ("severity", "current_status", "overall_severity", "overall_status")


def enum_name(f: Field, names: Mapping[int, str], default: str | None) -> Column:
    """Enum number -> name; text passes through; unknown numbers keep their text.

    ``names`` is the enum's own definition, so it is bounded by the contract and
    becomes one map literal instead of a join.
    """
    if names:
        pairs = [F.lit(x) for number, name in names.items() for x in (int(number), name)]
        listed = f.text.isin(*[str(int(number)) for number in names]) & ~V.is_string(f)
        known = F.when(listed, F.try_element_at(F.create_map(*pairs), f.get("int")))
    else:
        known = F.lit(None).cast("string")
    return F.when(f.text.isNotNull(), F.coalesce(known, f.text)).otherwise(F.lit(default))


def count_or_zero(f: Field) -> Column:
    """Whole number or 0: text such as '91.7' is not a whole number."""
    return F.coalesce(V.integer(f), F.lit(0).cast("bigint"))


def severity(envelope: Field) -> Column:
    """Top-level severity, else the first truthy severity key inside ``data``."""
    nested = [V.truthy_text(envelope / "data" / key) for key in SEVERITY_KEYS]
    return F.coalesce(V.truthy_text(envelope / "severity"), *nested)


def strip(value: Column) -> Column:
    """Drop all leading and trailing whitespace, not only blanks."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def row_id(asset_id: Column, layer_name: Column) -> Column:
    return F.concat_ws(":", asset_id, layer_name)


def link_severed(enabled: Column, toxics: Column) -> Column:
    """A disabled proxy or any toxic counts as severed; enabled by default."""
    return ~F.coalesce(enabled, F.lit(True)) | (
        F.coalesce(F.size(toxics), F.lit(0)) > 0
    )


def wgs84(kinematics: Field) -> tuple[Column, Column]:
    """(lat, lon) of a kinematics block; both NULL when one present value is unusable."""
    position = kinematics / "position"
    nested = V.truthy_block(position / "wgs84")
    lat, lat_bad = coordinate(position, nested, "latitude", "lat")
    lon, lon_bad = coordinate(position, nested, "longitude", "lon")
    usable = ~(lat_bad | lon_bad)
    return F.when(usable, lat), F.when(usable, lon)


def coordinate(
    position: Field, nested: Column, long_name: str, short_name: str
) -> tuple[Column, Column]:
    """Value of a coordinate, and whether it is present but not a number."""

    def number(f: Field) -> Column:
        return F.when(V.is_object(f), V.floating(f / "value")).otherwise(V.floating(f))

    def unusable(f: Field) -> Column:
        wrapped = (f / "value").variant.isNotNull() & ~F.is_variant_null((f / "value").variant)
        return F.when(V.is_object(f), wrapped).otherwise(F.lit(True)) & number(f).isNull()

    def pick(block: Field, read) -> Column:
        long_form, short_form = block / long_name, block / short_name
        return (
            F.when(V.is_present(long_form), read(long_form))
            .when(V.is_present(short_form), read(short_form))
        )

    inner = position / "wgs84"
    value = F.when(nested, pick(inner, number)).otherwise(pick(position, number))
    bad = F.when(nested, pick(inner, unusable)).otherwise(pick(position, unusable))
    return value, F.coalesce(bad, F.lit(False))

"""Ordered running sums that no group, however large, has to meet in one task for.

A row's place comes from a number that is spread evenly over [0, 1). Cutting that
interval into equal slices deals a group out to as many tasks as its rows need; the
slice is a pure function of the row, so a task that runs again deals the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a slice on average; a slice is sorted by one task.
ROWS_PER_SLICE = 4_096


def unit_number(digest: Column) -> Column:
    """The leading 52 bits of a hexadecimal digest as a number in [0, 1)."""
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return bits.cast("double") / F.lit(float(1 << 52))


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of the columns on both sides, where NULL equals NULL."""
    found = F.lit(True)
    for name in columns:
        found = found & left[name].eqNullSafe(right[name])
    return found


def running_sum(
    rows: DataFrame,
    groups: list[str],
    unit: str,
    group_rows: str,
    order: list[str],
    value: str,
    into: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``into``: the sum of ``value`` over the rows before this one in its group.

    ``unit`` is the row's number in [0, 1], ``group_rows`` the rows of its group, and
    ``order`` must begin with a column that sorts as ``unit`` does. Rows that tie in
    all of ``order`` take an arbitrary order among themselves.
    """
    slices = F.greatest(F.ceil(F.col(group_rows) / F.lit(rows_per_slice)), F.lit(1))
    dealt = rows.withColumn(
        "_slice", F.least(F.floor(F.col(unit) * slices), slices - 1).cast("long")
    )
    totals = dealt.groupBy(*groups, "_slice").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*groups) if groups else Window.partitionBy()
    starts = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_slice").alias("_start_slice"),
        F.coalesce(
            F.sum("_total").over(before.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_start"),
    )
    inside = (
        Window.partitionBy(*groups, "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    match = F.col("_slice") == F.col("_start_slice")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (
        local.join(starts, match)
        .withColumn(into, F.col("_start") + F.col("_inside"))
        .drop("_slice", "_start_slice", "_start", "_inside", *[f"_g{i}" for i in range(len(groups))])
    )

"""Exact nearest-site join for site tables of any size.

Positions become points on the unit sphere, cut into cubes of side 2 / 2**level.
The search starts with one pair (whole sphere of assets, whole sphere of sites) and
refines level by level: every asset tile keeps only the site cells that can still
hold its nearest site. A tile stops being refined once few sites are left for it
and it has few positions itself, so that no tile is a large group in the last join.

* Work follows distinct tiles and cells, not rows: an area with a third of all
  assets is one tile per level.
* Joins are equi-joins on a parent cell; nothing is paired with everything. They are always
  shuffled: tiles and cells grow with the input, and files or shuffles of small integers that look
  small enough to broadcast are many times that in the driver's memory.
* A bound is always the distance to a real site, so no nearest site is lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from readmill.functions.geo import great_circle_km, unit_vector
from readmill.session import materialise

STEP = 2
# Tiles down to this level (about 3 km) are counted once and reused for coarser ones.
SHARED_LEVEL = 12
# Sides of 12 mm: finer positions are rounding noise.
LAST_LEVEL = 30
# Candidate sites and positions a tile may keep without being refined further.
FEW_SITES = 48
FEW_POINTS = 8_192
# Slack for rounding, in units of the Earth radius (6 mm).
SLACK = 1e-9

_AXES = ("x", "y", "z")


def _index(axis: str, level: int) -> Column:
    count = 1 << level
    raw = F.floor((F.col(axis) + 1.0) * F.lit(count / 2.0))
    return F.least(F.greatest(raw, F.lit(0)), F.lit(count - 1)).cast("int")


def _cells(prefix: str, level: int) -> list[Column]:
    return [_index(a, level).alias(f"{prefix}{a}") for a in _AXES]


def _parents(prefix: str, shift: int, out: str) -> list[Column]:
    return [F.shiftright(F.col(f"{prefix}{a}"), shift).alias(f"{out}{a}") for a in _AXES]


def _keys(prefix: str) -> list[str]:
    return [f"{prefix}{a}" for a in _AXES]


def _with_vectors(df: DataFrame) -> DataFrame:
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    return df.withColumns({"x": x, "y": y, "z": z})


def _squares(terms: list[Column]) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [t * t for t in terms]))


def _farthest(level: int) -> Column:
    """Largest distance from any point of the tile to the cell's sample site."""
    side = 2.0 / (1 << level)
    terms = []
    for a in _AXES:
        low = F.col(f"t{a}") * F.lit(side) - 1.0
        at = F.col(f"sample.{a}")
        terms.append(F.greatest(F.abs(at - low), F.abs(at - low - F.lit(side))))
    return _squares(terms)


def _closest(level: int) -> Column:
    """Smallest distance between the tile and the cell."""
    side = 2.0 / (1 << level)
    gaps = [
        F.greatest(F.abs(F.col(f"t{a}") - F.col(f"c{a}")) - 1, F.lit(0)) * F.lit(side)
        for a in _AXES
    ]
    return _squares(gaps)


class SiteIndex:
    """The side of the sites, worked out once: places and counted cells.

    ``sites`` has ordinal, edge_id, region_id, lat, lon and label.
    """

    def __init__(self, sites: DataFrame):
        # At equal coordinates the lowest ordinal always wins, so copies can go.
        located = sites.filter("lat is not null and lon is not null")
        self.places = materialise(
            _with_vectors(
                located.groupBy("lat", "lon")
                .agg(F.min(F.struct("ordinal", "edge_id", "region_id", "label")).alias("site"))
            ),
            "places",
        )
        self.cells = materialise(_count_cells(self.places, SHARED_LEVEL), "cells")


def nearest_by_tiles(positions: DataFrame, index: SiteIndex) -> DataFrame:
    """(_near_lat, _near_lon) of ``positions`` -> struct ``_near`` of the nearest site.

    Ties go to the lower ordinal. Rows with a missing coordinate get no result.
    """
    places, cells = index.places, index.cells
    points = materialise(
        _with_vectors(
            positions.select(F.col("_near_lat").alias("lat"), F.col("_near_lon").alias("lon"))
            .filter("lat is not null and lon is not null")
            .distinct()
        ),
        "points",
    )
    tiles = materialise(_count_tiles(points, SHARED_LEVEL), "tiles")

    spark = positions.sparkSession
    start = [F.lit(0).cast("int").alias(k) for k in _keys("t") + _keys("c")]
    pairs = spark.range(1).select(*start, F.lit(4.0).alias("bound"))
    settled: list[tuple[int, DataFrame]] = []
    for level in range(STEP, LAST_LEVEL + 1, STEP):
        refined = materialise(
            _refine(pairs, _tiles_at(points, tiles, level), _cells_at(places, cells, level), level),
            f"pairs-{level}",
        )
        done = F.lit(level >= LAST_LEVEL) | ((F.col("left") <= FEW_SITES) & (F.col("held") <= FEW_POINTS))
        settled.append((level, refined.filter(done)))
        pairs = refined.filter(~done).select(*_keys("t"), *_keys("c"), "bound")
        if pairs.isEmpty():
            break
    return _closest_of(points, places, settled)


def _count_cells(places: DataFrame, level: int) -> DataFrame:
    return (
        places.select(*_cells("c", level), "site.ordinal", "x", "y", "z")
        .groupBy(*_keys("c"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("ordinal", "x", "y", "z")).alias("sample"),
        )
    )


def _count_tiles(points: DataFrame, level: int) -> DataFrame:
    return points.select(*_cells("t", level)).groupBy(*_keys("t")).agg(F.count(F.lit(1)).alias("held"))


def _tiles_at(points: DataFrame, tiles: DataFrame, level: int) -> DataFrame:
    if level > SHARED_LEVEL:
        return _count_tiles(points, level)
    return tiles.select(*_parents("t", SHARED_LEVEL - level, "t"), "held").groupBy(*_keys("t")).agg(F.sum("held").alias("held"))


def _cells_at(places: DataFrame, cells: DataFrame, level: int) -> DataFrame:
    if level > SHARED_LEVEL:
        return _count_cells(places, level)
    return (
        cells.select(*_parents("c", SHARED_LEVEL - level, "c"), "n", "sample")
        .groupBy(*_keys("c"))
        .agg(F.sum("n").alias("n"), F.min("sample").alias("sample"))
    )


def _shuffled(df: DataFrame) -> DataFrame:
    """A side that is joined by sorting, whatever its size is taken for."""
    return df.hint("merge")


def _refine(pairs: DataFrame, tiles: DataFrame, cells: DataFrame, level: int) -> DataFrame:
    """Children of every pair that can still hold the tile's nearest site."""
    parents = pairs.select(
        *[F.col(k).alias(f"p{k}") for k in _keys("t") + _keys("c")], "bound"
    )
    child_tiles = tiles.select(*_keys("t"), *_parents("t", STEP, "pt"), "held")
    child_cells = cells.select(*_keys("c"), *_parents("c", STEP, "pc"), "n", "sample")
    children = parents.join(_shuffled(child_tiles), _keys("pt")).join(_shuffled(child_cells), _keys("pc"))
    per_tile = Window.partitionBy(*_keys("t"))
    return (
        children.withColumn("bound", F.least(F.col("bound"), _farthest(level)))
        .withColumn("bound", F.min("bound").over(per_tile))
        .filter(_closest(level) <= F.col("bound") + F.lit(SLACK))
        .withColumn("left", F.sum("n").over(per_tile))
        .select(*_keys("t"), *_keys("c"), "bound", "left", "held")
    )


def _closest_of(
    points: DataFrame, places: DataFrame, settled: list[tuple[int, DataFrame]]
) -> DataFrame:
    parts = []
    for level, pairs in settled:
        held = places.select(*_cells("c", level), "lat", "lon", "site")
        parts.append(
            pairs.select(*_keys("t"), *_keys("c"))
            .join(_shuffled(held), _keys("c"))
            .select(F.lit(level).alias("level"), *_keys("t"), F.col("lat").alias("site_lat"), F.col("lon").alias("site_lon"), "site")
        )
    candidates = reduce(DataFrame.unionByName, parts)
    placements = F.explode(
        F.array(*[F.struct(F.lit(n).alias("level"), *_cells("t", n)) for n, _ in settled])
    )
    spread = points.select("lat", "lon", placements.alias("_at")).select("lat", "lon", "_at.*")
    km = great_circle_km(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"))
    best = F.min(
        F.struct(
            km.alias("km"),
            F.col("site.ordinal").alias("ordinal"),
            F.col("site.edge_id").alias("edge_id"),
            F.col("site.region_id").alias("region_id"),
            F.col("site.label").alias("label"),
        )
    )
    return (
        spread.join(_shuffled(candidates), ["level", *_keys("t")])
        .groupBy(F.col("lat").alias("_near_lat"), F.col("lon").alias("_near_lon"))
        .agg(best.alias("_near"))
    )

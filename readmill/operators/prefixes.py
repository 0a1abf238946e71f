"""Longest prefix for prefix tables of any size, by one pass over ids and prefixes in order.

Ids and prefixes are sorted together, by ranges of their bytes. In that order every prefix stands
before what it encloses, and enclosing prefixes are nested, so that a stack holds those that are open.
A range is walked with a stack that begins empty; what a prefix of an earlier range encloses is then
left over, but only ids ahead of any prefix of their own range, and such a prefix is also one
of the range's first name. These few are looked up for the first names alone: one row a range.

The shuffle moves each id and each prefix once, whatever the lengths of prefixes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmill.session import materialise, ship_library

_WALKED = "name binary, prefix binary, edge_id string, region_id string, first binary"


def _walk(batches):
    """Ids with the innermost prefix that encloses them, or else the first name of their range."""
    first, open_prefixes = None, []
    for rows in batches:
        found = []
        for name, asked, edge_id, region_id in rows.itertuples(index=False, name=None):
            first = name if first is None else first
            while open_prefixes and not name.startswith(open_prefixes[-1][0]):
                open_prefixes.pop()
            if not asked:
                open_prefixes.append((name, edge_id, region_id))
            elif open_prefixes:
                found.append((name, *open_prefixes[-1], None))
            else:
                found.append((name, None, None, None, first))
        yield pd.DataFrame(found, columns=["name", "prefix", "edge_id", "region_id", "first"], dtype=object)


def longest_in_order(ids: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Struct ``_hit`` (prefix, edge_id, region_id) of each ``id`` that a prefix encloses.

    ``ids`` has distinct ids, not NULL, in ``id``; ``prefixes`` has distinct prefixes, not NULL, with
    edge_id and region_id.
    """
    ship_library(ids.sparkSession)
    nothing = F.lit(None).cast("string")
    asked = ids.select(
        F.col("id").cast("binary").alias("name"), F.lit(True).alias("asked"), nothing.alias("edge_id"), nothing.alias("region_id")
    )
    given = prefixes.select(F.col("prefix").cast("binary").alias("name"), F.lit(False).alias("asked"), "edge_id", "region_id")
    # A prefix stands before an id equal to it.
    ordered = asked.unionByName(given).repartitionByRange("name").sortWithinPartitions("name", "asked")
    walked = materialise(ordered.mapInPandas(_walk, _WALKED), "prefix-walk")
    hit = F.struct(F.col("prefix").cast("string").alias("prefix"), "edge_id", "region_id")
    inside = walked.where("prefix IS NOT NULL").select(F.col("name").cast("string").alias("id"), hit.alias("_hit"))

    left = walked.where("prefix IS NULL").select(F.col("name").cast("string").alias("id"), F.col("first").cast("string").alias("first"))
    longest = prefixes.agg(F.max(F.length("prefix"))).first()[0] or 0
    lengths = F.sequence(F.lit(0), F.least(F.length("first"), F.lit(longest)))
    heads = left.select("first").distinct().select(
        "first", F.explode(F.transform(lengths, lambda n: F.substring(F.col("first"), F.lit(1), n))).alias("prefix")
    )
    ranges = heads.join(prefixes, "prefix").groupBy("first").agg(
        F.collect_list(F.struct(F.length("prefix").alias("n"), "prefix", "edge_id", "region_id")).alias("enclosing")
    )
    # At most one row a range, with prefixes of its first name only.
    late = left.join(F.broadcast(ranges), "first").select(
        "id", F.array_max(F.filter("enclosing", lambda p: F.startswith("id", p["prefix"]))).alias("p")
    )
    return inside.unionByName(
        late.where("p IS NOT NULL").select("id", F.struct("p.prefix", "p.edge_id", "p.region_id").alias("_hit"))
    )

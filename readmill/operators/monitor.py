"""Lag, link health, counters and the throttled fallback report."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readmill.functions.scalars import link_severed

# Lag when there is no reading, topics and singleton row of the status.
LAG_UNKNOWN = -1
NOT_COMMITTED = -1001
BRIDGE_TOPICS = ("raw-sensor-stream", "tactical-events")
STATUS_ID = "edge"

# Fixed value: seconds between two reports of the same fallback.
FALLBACK_WINDOW_S = 60


def partition_lag() -> Column:
    """Messages still to be read; uncommitted partitions count from their low mark, and are NULL where that is unknown."""
    position = F.when(F.col("committed") >= 0, F.col("committed")).otherwise(F.col("lo"))
    behind = F.col("hi") - position
    return F.when(behind.isNotNull(), F.greatest(F.lit(0), behind))


def _known_sum() -> Column:
    """Summed lag; NULL when that of any partition is unknown."""
    return F.when(F.count_if(partition_lag().isNull()) == 0, F.sum(partition_lag()))


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Lag per topic over (topic, partition, lo, hi, committed); -1 where a partition's lag is unknown."""
    return offsets.groupBy("topic").agg(F.coalesce(_known_sum(), F.lit(LAG_UNKNOWN)).alias("lag"))


def edge_buffer_status(
    offsets: DataFrame,
    link_status: DataFrame,
    group: str,
    proxy: str,
    as_of: Column,
    topics: Sequence[str] = BRIDGE_TOPICS,
) -> DataFrame:
    """The singleton status row.

    A group without rows, or with a partition whose lag is unknown, has an unknown lag (-1), never 0; a missing link
    row leaves the link unsevered. Either makes the probe unhealthy.
    """
    read = offsets.filter((F.col("group") == group) & F.col("topic").isin(*topics)).agg(
        F.count(F.lit(1)).alias("_rows"), _known_sum().alias("_lag")
    )
    link = link_status.filter(F.col("proxy") == proxy).agg(
        F.count(F.lit(1)).alias("_links"),
        F.bool_or(link_severed(F.col("enabled"), F.col("toxics"))).alias("_severed"),
    )
    # Both sides are global aggregates: exactly one row each.
    both = read.withColumn("_one", F.lit(1)).join(link.withColumn("_one", F.lit(1)), "_one")
    known = (F.col("_rows") > 0) & F.col("_lag").isNotNull()
    return both.select(
        F.lit(STATUS_ID).alias("id"),
        F.when(known, F.col("_lag")).otherwise(F.lit(LAG_UNKNOWN)).cast("bigint").alias("bridge_group_lag"),
        F.coalesce(F.col("_severed"), F.lit(False)).alias("hq_link_severed"),
        (known & (F.col("_links") > 0)).alias("probe_healthy"),
        as_of.alias("updated_at"),
    )


def progress_offsets(progress: dict, group: str) -> list[tuple[str, str, int, None, int, int]]:
    """(group, topic, partition, lo, hi, committed) rows of one streaming progress report.

    The report does not tell low marks, so ``lo`` is unknown. Sources without partitions give no rows.
    """
    rows = []
    for source in progress.get("sources", []):
        done, latest = source.get("endOffset") or {}, source.get("latestOffset") or {}
        named = {t: p for t, p in latest.items() if isinstance(p, dict)} if isinstance(latest, dict) else {}
        for topic, partitions in named.items():
            for partition, high in partitions.items():
                committed = done.get(topic, {}).get(partition, NOT_COMMITTED)
                rows.append((group, topic, int(partition), None, int(high), int(committed)))
    return rows


def outcome_counters(projected: DataFrame, table: str) -> DataFrame:
    """Counter rows (metric, label, value) of projected messages.

    One aggregation over the outcome column; the counters are derived from its few rows.
    """
    counts = projected.groupBy("topic", "outcome").agg(F.count(F.lit(1)).alias("n"))
    failed = F.col("outcome").isin("DecodeError", "handler_exception")
    entries = F.filter(
        F.array(
            _counter("messages_consumed", F.col("topic"), F.lit(True)),
            _counter("rows_written", F.lit(table), F.col("outcome") == "written"),
            _counter("decode_errors", F.concat_ws(":", "topic", "outcome"), failed),
            _counter("write_errors", F.lit(f"write:{table}"), F.col("outcome") == "write_error"),
        ),
        lambda e: e["counted"],
    )
    return (
        counts.select("n", F.explode(entries).alias("e"))
        .groupBy(F.col("e.metric").alias("metric"), F.col("e.label").alias("label"))
        .agg(F.sum("n").alias("value"))
    )


def _counter(metric: str, label: Column, counted: Column) -> Column:
    return F.struct(F.lit(metric).alias("metric"), label.alias("label"), counted.alias("counted"))


def fallback_report(
    fallbacks: DataFrame,
    keys: Sequence[str],
    seconds: str,
    window_s: int = FALLBACK_WINDOW_S,
) -> DataFrame:
    """Throttled reports: (keys, ``seconds``, suppressed).

    A key reports at its first fallback and then at the first one at least
    ``window_s`` after its last report, with the number left out in between; a
    trailing count is never reported. ``seconds`` is a whole-second BIGINT.

    Equal seconds collapse before the shuffle, so a hot key is at most one row per
    second of the time covered. Keys are then scanned in time order with constant
    state; a key may span any number of Arrow batches.
    """
    keys = list(keys)
    ticks = fallbacks.groupBy(*keys, seconds).agg(F.count(F.lit(1)).alias("_n"))
    ordered = ticks.repartition(*keys).sortWithinPartitions(*keys, seconds)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ticks.schema if f.name != "_n"]
    schema = ", ".join([*fields, "suppressed bigint"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, last, left_out = None, 0, 0
        for batch in batches:
            if batch.empty:
                continue
            at, n = batch[seconds].to_numpy(), batch["_n"].to_numpy()
            ids = list(zip(*[batch[k].tolist() for k in keys]))
            changed = np.ones(len(batch), dtype=bool)
            changed[1:] = [a != b for a, b in zip(ids[1:], ids[:-1])]
            starts = np.flatnonzero(changed)
            rows: list[int] = []
            counts: list[int] = []
            for start, end in zip(starts, [*starts[1:], len(batch)]):
                same = key is not None and ids[start] == key
                key = ids[start]
                row = start
                if same:
                    row = start + int(np.searchsorted(at[start:end], last + window_s))
                    left_out += int(n[start:row].sum())
                else:
                    left_out = 0
                while row < end:
                    rows.append(row)
                    counts.append(left_out)
                    last = int(at[row])
                    following = row + int(np.searchsorted(at[row:end], last + window_s))
                    left_out = int(n[row:following].sum()) - 1
                    row = following
            found = batch.iloc[rows].drop(columns="_n")
            yield found.assign(suppressed=counts)

    return ordered.mapInPandas(scan, schema)

"""The throttled fallback report as a second sink of a micro-batch.

A key is (topic, edge it fell back to, row key). Its state is when it last reported and how many fallbacks it has left
out since. The state after a batch is written beside the tables under the batch's number, so a batch that is delivered
again starts from the state that the batch before it left, and replaces its own reports.

State expires: a key that has left nothing out goes when its window is over, which changes no report; a key with a count
goes ``keep_s`` after its last report, and the count with it. Both go by the seconds of the messages, which must not
fall from batch to batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readmill import files
from readmill.operators.monitor import FALLBACK_WINDOW_S

KEYS = ("topic", "edge_id", "row_key")
#: Seconds after which a count that was never reported is forgotten.
KEEP_S = 24 * 3600
_KEPT_STATES = 2

_REPORTS = "array<struct<second: bigint, suppressed: bigint>>"


def fallback_ticks(projected: DataFrame, row_key: str, as_of: Column) -> DataFrame:
    """Fallbacks a key and second, counted before anything is grouped by key."""
    fallbacks = projected.where("outcome = 'written' AND provenance_fallback")
    seen = fallbacks.select(
        "topic", "edge_id", F.col(row_key).cast("string").alias("row_key"), F.unix_seconds(as_of).alias("second")
    )
    return seen.groupBy(*KEYS, "second").agg(F.count(F.lit(1)).alias("n"))


def throttled(ticks: DataFrame, state: DataFrame | None, window_s: int, keep_s: int) -> DataFrame:
    """Keys with their new state and the reports of this batch; one fold a key over its seconds in order."""
    entry = F.struct("second", "n")
    rows = ticks.select(*KEYS, entry.alias("tick"), F.lit(None).cast("bigint").alias("last"), F.lit(None).cast("bigint").alias("left_out"))
    if state is not None:
        rows = rows.unionByName(state.select(*KEYS, "last", "left_out"), allowMissingColumns=True)
    grouped = rows.groupBy(*KEYS).agg(
        F.sort_array(F.collect_list("tick")).alias("ticks"), F.max("last").alias("last"), F.max("left_out").alias("left_out")
    )

    def step(acc: Column, tick: Column) -> Column:
        since = tick["second"] - acc["last"]
        due = acc["last"].isNull() | (since >= window_s)
        left_out = F.when(since > keep_s, F.lit(0)).otherwise(F.coalesce(acc["left_out"], F.lit(0)))
        report = F.array(F.struct(tick["second"].alias("second"), left_out.cast("bigint").alias("suppressed")))
        return F.struct(
            F.when(due, tick["second"]).otherwise(acc["last"]).alias("last"),
            F.when(due, tick["n"] - 1).otherwise(acc["left_out"] + tick["n"]).alias("left_out"),
            F.when(due, F.concat(acc["reports"], report)).otherwise(acc["reports"]).alias("reports"),
        )

    start = F.struct("last", "left_out", F.array().cast(_REPORTS).alias("reports"))
    folded = grouped.withColumn("folded", F.aggregate("ticks", start, step))
    seen = F.greatest(F.col("folded.last"), F.element_at(F.col("ticks.second"), F.lit(-1)))
    return folded.select(*KEYS, "folded.last", "folded.left_out", "folded.reports", F.when(F.size("ticks") > 0, seen).otherwise(F.col("last")).alias("seen"))


def _unexpired(state: DataFrame, window_s: int, keep_s: int) -> DataFrame:
    clock = state.agg(F.max("seen")).first()[0]
    idle = F.lit(clock) - F.col("last")
    return state.where((idle < window_s) | ((F.col("left_out") > 0) & (idle <= keep_s)))


class FallbackReports:
    """State and reports of one topic below a store's root."""

    def __init__(self, spark: SparkSession, root: str, topic: str, window_s: int = FALLBACK_WINDOW_S, keep_s: int = KEEP_S) -> None:
        if keep_s < window_s:
            raise ValueError(f"state kept for {keep_s} s would end inside the window of {window_s} s")
        self._spark, self._topic = spark, topic
        self._states, self._reports = f"{root}/fallback_state/{topic}", f"{root}/fallback_reports/{topic}"
        self._window_s, self._keep_s = window_s, keep_s

    def _batches(self) -> list[int]:
        """Batches with a finished state, oldest first; at most a few, as older ones are removed."""
        found = [int(n) for n in files.children(self._spark, self._states) if n.isdigit()]
        return sorted(b for b in found if files.exists(self._spark, f"{self._states}/{b}/_SUCCESS"))

    def state(self, before: int | None = None) -> DataFrame | None:
        """Keys that can still change a report, as they stood before a batch (or are now)."""
        earlier = [b for b in self._batches() if before is None or b < before]
        if not earlier:
            return None
        return _unexpired(self._spark.read.parquet(f"{self._states}/{earlier[-1]}"), self._window_s, self._keep_s)

    def write_batch(self, ticks: DataFrame, batch_id: int) -> None:
        """Reports of one batch. A batch without fallbacks need not be written: it changes neither state nor reports."""
        target = f"{self._states}/{batch_id}"
        after = throttled(ticks, self.state(before=batch_id), self._window_s, self._keep_s)
        after.write.mode("overwrite").parquet(target)
        reports = self._spark.read.parquet(target).select(*KEYS, F.inline("reports"))
        reports.write.mode("overwrite").parquet(f"{self._reports}/batch_id={batch_id}")
        for old in [b for b in self._batches() if b <= batch_id][:-_KEPT_STATES]:
            files.remove(self._spark, f"{self._states}/{old}")

    def read(self) -> DataFrame:
        """All reports: topic, edge_id, row_key, second, suppressed."""
        schema = "topic string, edge_id string, row_key string, second bigint, suppressed bigint"
        if not files.children(self._spark, self._reports):
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(f"{schema}, batch_id bigint").parquet(self._reports).drop("batch_id")

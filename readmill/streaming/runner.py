"""One streaming query per topic: read -> decode -> project -> idempotent sink.

Delivery is at least once; the sinks make a repeated batch harmless. A failing batch
fails its query, which restarts from the checkpoint: nothing is dropped silently.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from readmill.operators import quarantine as Q
from readmill.operators import retention
from readmill.plans.batch import Settings, project_messages, rows_to_write
from readmill.plans.projections import Projection, table_columns
from readmill.sources.tables import EventLog, UpsertTable, _overwrite_partitions
from readmill.streaming import offsets
from readmill.streaming.fallbacks import FallbackReports, fallback_ticks

# Fixed value: milliseconds a micro-batch may wait.
TRIGGER_MS = 200


@dataclass(frozen=True)
class Store:
    """Folder layout of all read models below one root."""

    spark: SparkSession
    root: str

    def table(self, projection: Projection, schema) -> UpsertTable | EventLog:
        kind = UpsertTable if projection.mode == "upsert" else EventLog
        return kind(self.spark, f"{self.root}/tables/{projection.table}", projection.keys, schema)

    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    def metrics_path(self) -> str:
        return f"{self.root}/pipeline_metrics"

    def fallbacks(self, projection: Projection, settings: Settings = Settings()) -> FallbackReports:
        """Throttled reports of rows whose origin fell back to the site's defaults."""
        window, keep = settings.fallback_window_s, settings.fallback_keep_s
        return FallbackReports(self.spark, self.root, projection.topic, window, keep)

    def consumed(self) -> DataFrame:
        """(topic, partition, committed): how far the streams have come."""
        return offsets.consumed(self.spark, self.root)


def table_schema(spark: SparkSession, projection: Projection, settings: Settings = Settings()):
    """Schema of the read model, taken from the projection itself."""
    from readmill.sources.envelopes import MESSAGE_SCHEMA

    nothing = spark.createDataFrame([], MESSAGE_SCHEMA)
    projected = project_messages(nothing, projection, settings)
    return projected.select(*table_columns(projection, projected)).schema


def batch_writer(
    projection: Projection,
    store: Store,
    settings: Settings = Settings(),
    as_of: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a projection."""
    schema = table_schema(store.spark, projection, settings)

    def write(messages: DataFrame, batch_id: int) -> None:
        session = messages.sparkSession
        own = Store(session, store.root)
        consumed = Observation(f"consumed-{projection.name}-{batch_id}")
        counted = messages.observe(consumed, F.count(F.lit(1)).alias("n"))
        projected = project_messages(counted, projection, settings, as_of)
        # Decoded once, used by the table, the quarantine and the counters.
        projected = projected.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            written = Observation(f"written-{projection.name}-{batch_id}")
            rows = rows_to_write(projected, projection).observe(
                written, F.count(F.lit(1)).alias("n")
            )
            if not own.table(projection, schema).write_batch(rows, batch_id):
                return  # an older batch, of which everything was written long ago
            failures = Q.quarantined(projected).withColumn("batch_id", F.lit(batch_id))
            _overwrite_partitions(failures, own.quarantine_path(), "topic", "batch_id")
            fell_back = F.col("provenance_fallback") if projection.origin == "fieldwise" else F.lit(False)
            # One row a partition and outcome.
            found = projected.groupBy("partition", "outcome").agg(
                F.count(F.lit(1)).alias("n"), F.max("offset").alias("last"), F.count_if(fell_back).alias("fallbacks")
            ).collect()
            if any(r["fallbacks"] for r in found if r["outcome"] == Q.WRITTEN):
                moment = F.current_timestamp() if as_of is None else as_of
                ticks = fallback_ticks(projected, projection.keys[0], moment)
                own.fallbacks(projection, settings).write_batch(ticks, batch_id)
            outcomes, through = Counter(), {}
            for row in found:
                outcomes[row["outcome"]] += row["n"]
                if row["partition"] is not None and row["last"] is not None:
                    through[row["partition"]] = max(row["last"], through.get(row["partition"], row["last"]))
            _write_metrics(own, projection, batch_id, consumed.get["n"], written.get["n"], outcomes)
            if through:
                positions = offsets.consumed_rows(session, projection.topic, batch_id, through)
                _overwrite_partitions(positions.coalesce(1), offsets.consumed_path(own.root), "topic", "batch_id")
        finally:
            projected.unpersist()

    return write


def _write_metrics(store, projection, batch_id, consumed, written, outcomes) -> None:
    topic, table = projection.topic, projection.table
    rows = [("messages_consumed", topic, consumed), ("rows_written", table, written)]
    for reason in (Q.DECODE_ERROR, Q.HANDLER_EXCEPTION):
        if outcomes.get(reason):
            rows.append(("decode_errors", f"{topic}:{reason}", outcomes[reason]))
    if outcomes.get(Q.WRITE_ERROR):
        rows.append(("write_errors", f"write:{table}", outcomes[Q.WRITE_ERROR]))
    counters = store.spark.createDataFrame(rows, "metric string, label string, value bigint")
    stamped = counters.withColumns(
        {"topic": F.lit(topic), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    _overwrite_partitions(stamped.coalesce(1), store.metrics_path(), "topic", "batch_id")


def maintain(
    store: Store,
    projections: Iterable[Projection],
    as_of: datetime,
    ttl_override: int | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Prune, compact and vacuum every table once, busy or idle: (metric, label, value) with the rows pruned of each.

    A batch job to run every hour or so beside the streams: it touches committed batches only, and a batch that a stream
    delivers again meanwhile is in the table afterwards. The counts also go to the metrics.
    """
    rows = []
    for projection in retention.resolve_ttl(projections, ttl_override):
        table = store.table(projection, table_schema(store.spark, projection, settings))
        pruned = table.prune(as_of, retention.prune_target(projection)[1])
        table.compact()
        table.vacuum()
        rows.append(("rows_pruned", projection.table, pruned, projection.topic))
    counters = store.spark.createDataFrame(rows, "metric string, label string, value bigint, topic string")
    # Runs are told apart from micro-batches by their sign.
    stamped = counters.withColumn("batch_id", F.lit(-int(as_of.timestamp())).cast("bigint"))
    _overwrite_partitions(stamped.coalesce(1), store.metrics_path(), "topic", "batch_id")
    return counters.drop("topic")


def start(
    projection: Projection,
    messages: DataFrame,
    store: Store,
    settings: Settings = Settings(),
    as_of: Column | None = None,
    available_now: bool = False,
    trigger_ms: int = TRIGGER_MS,
) -> StreamingQuery:
    """Start the query of one topic; its checkpoint lives beside the tables."""
    writer = (
        messages.writeStream.queryName(f"{projection.name}")
        .option("checkpointLocation", f"{store.root}/checkpoints/{projection.name}")
        .foreachBatch(batch_writer(projection, store, settings, as_of))
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{trigger_ms} milliseconds"}
    return writer.trigger(**trigger).start()


def run_available(
    projection: Projection,
    messages: DataFrame,
    store: Store,
    settings: Settings = Settings(),
    as_of: Column | None = None,
) -> None:
    """Process what is there and stop; errors of the query are raised here."""
    start(projection, messages, store, settings, as_of, available_now=True).awaitTermination()

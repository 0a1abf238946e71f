"""Positions of the streams, and lag from them.

``consumed`` holds, for every micro-batch, the position after the last message of each partition; the runner writes it
once the batch is in its table. Ends of the partitions come from the source: a Kafka source tells them with its
progress, which ``EndMarks`` writes down; for files they are counted from the messages.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from readmill import files
from readmill.operators.monitor import NOT_COMMITTED, progress_offsets

_CONSUMED = "partition int, committed bigint"
_MARKS = "topic string, partition int, lo bigint, hi bigint"
_KEPT_MARKS = 16


def consumed_path(root: str) -> str:
    return f"{root}/consumed"


def consumed_rows(spark: SparkSession, topic: str, batch_id: int, through: dict[int, int]) -> DataFrame:
    """One row a partition of a batch: the offset after its last message."""
    rows = spark.createDataFrame([(p, last + 1) for p, last in sorted(through.items())], _CONSUMED)
    return rows.withColumns({"topic": F.lit(topic), "batch_id": F.lit(batch_id).cast("bigint")})


def consumed(spark: SparkSession, root: str) -> DataFrame:
    """(topic, partition, committed) over all batches; empty before the first."""
    if not files.children(spark, consumed_path(root)):
        return spark.createDataFrame([], "topic string, partition int, committed bigint")
    rows = spark.read.schema(f"{_CONSUMED}, topic string, batch_id bigint").parquet(consumed_path(root))
    return rows.groupBy("topic", "partition").agg(F.max("committed").alias("committed"))


def ends_of(messages: DataFrame) -> DataFrame:
    """(topic, partition, lo, hi) of messages that are at rest."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("lo"), (F.max("offset") + 1).alias("hi")
    )


def stream_offsets(ends: DataFrame, positions: DataFrame, group: str) -> DataFrame:
    """Rows for ``monitor.consumer_lag``; partitions nobody has read yet are not committed."""
    both = ends.join(positions.hint("merge"), ["topic", "partition"], "left")
    committed = F.coalesce("committed", F.lit(NOT_COMMITTED)).cast("bigint").alias("committed")
    return both.select(F.lit(group).alias("group"), "topic", "partition", "lo", "hi", committed)


class EndMarks(StreamingQueryListener):
    """Writes the ends that sources report with their progress: ``spark.streams.addListener(EndMarks(spark, root))``.

    One small file a progress report of a source that names partitions; the newest few stay. The low mark is not
    part of a progress report, so the lag of a partition that was never committed stays unknown.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._folder = spark, f"{root}/end_marks"

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.note(json.loads(event.progress.json))

    def note(self, progress: dict) -> None:
        rows = progress_offsets(progress, progress.get("name") or progress["runId"])
        if not rows:
            return
        query = f"{self._folder}/query={progress.get('name') or progress['runId']}"
        marks = [json.dumps(dict(zip(("topic", "partition", "lo", "hi"), row[1:5]))) for row in rows]
        name = f"{progress['timestamp'].replace(':', '')}-{progress['batchId']:012d}.json"
        files.create_text(self._spark, f"{query}/{name}", "\n".join(marks))
        for old in files.children(self._spark, query)[:-_KEPT_MARKS]:
            files.remove(self._spark, f"{query}/{old}")

    def read(self) -> DataFrame:
        """(topic, partition, lo, hi): the highest end known of each partition."""
        if not files.children(self._spark, self._folder):
            return self._spark.createDataFrame([], _MARKS)
        rows = self._spark.read.schema(_MARKS).json(self._folder)
        return rows.groupBy("topic", "partition").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))

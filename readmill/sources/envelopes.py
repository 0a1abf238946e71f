"""Keyed message streams with the columns of the Kafka source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)
MESSAGE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

# Fixed value: consumer limit of 16 MiB per message.
MAX_MESSAGE_BYTES = 16 * 1024 * 1024


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = 1_000_000, **options: str
) -> DataFrame:
    """One topic as a stream, from the earliest offset (needs the Kafka connector).

    ``max_offsets`` bounds a trigger for the whole topic. The connector derives its
    group id per query; progress lives in the query's checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_offsets))
        .option("kafka.max.partition.fetch.bytes", str(MAX_MESSAGE_BYTES))
        .option("kafka.fetch.max.bytes", str(MAX_MESSAGE_BYTES))
    )
    for name, setting in options.items():
        reader = reader.option(name, setting)
    return reader.load().select(*MESSAGE_COLUMNS)


def file_stream(
    spark: SparkSession, path: str, max_files: int | None = None, topic: str | None = None
) -> DataFrame:
    """Parquet files of messages as a stream."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _of_topic(reader.parquet(path), topic)


def replay(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """The same files as a batch."""
    return _of_topic(spread(spark.read.schema(MESSAGE_SCHEMA).parquet(path)), topic)


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a scan, dealt over all cores if the scan has fewer splits than those.

    Decoding costs some 0.1 ms a message, far more than moving it, and a file with one row group
    is one split whatever its size. Scans with enough splits stay as they are, without a shuffle.
    (Kafka has ``minPartitions`` for this.) Only for scans: other plans would run to count their splits.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _of_topic(messages: DataFrame, topic: str | None) -> DataFrame:
    return messages if topic is None else messages.filter(F.col("topic") == topic)

"""Outcome of every message, and reports over the failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Outcome labels.
WRITTEN = "written"
SKIPPED = "skipped"
DECODE_ERROR = "DecodeError"
HANDLER_EXCEPTION = "handler_exception"
WRITE_ERROR = "write_error"
FAILURES = (DECODE_ERROR, HANDLER_EXCEPTION, WRITE_ERROR)

# Fixed value: characters of the error text that identify a distinct failure.
SIGNATURE_LENGTH = 80


def outcome() -> Column:
    """One label per projected message; decoding comes first, then mapping errors, then skips."""
    return (
        F.when(F.col("decode_error").isNotNull(), DECODE_ERROR)
        .when(F.col("handler_error").isNotNull(), HANDLER_EXCEPTION)
        .when(F.col("skipped"), SKIPPED)
        .when(F.col("write_error").isNotNull(), WRITE_ERROR)
        .otherwise(WRITTEN)
    )


def good_rows(projected: DataFrame) -> DataFrame:
    return projected.filter(F.col("outcome") == WRITTEN)


def quarantined(projected: DataFrame) -> DataFrame:
    """Failed messages with their bytes, reason and detail. Skips are not failures."""
    detail = F.coalesce("decode_error", "handler_error", "write_error")
    return projected.filter(F.col("outcome").isin(*FAILURES)).select(
        "topic", "partition", "offset", "key", "value",
        F.col("outcome").alias("reason"), detail.alias("detail"),
    )


def distinct_failures(quarantine: DataFrame) -> DataFrame:
    """One row per (topic, error signature): how often and where it began."""
    return quarantine.groupBy(
        "topic", F.substring("detail", 1, SIGNATURE_LENGTH).alias("signature")
    ).agg(F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"))


def outcome_counts(projected: DataFrame) -> DataFrame:
    """Messages per topic and outcome."""
    return projected.groupBy("topic", "outcome").agg(F.count(F.lit(1)).alias("messages"))

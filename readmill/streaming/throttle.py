"""Streaming form of the throttled fallback report.

The state of a key is two numbers: when it last reported, and how many fallbacks it
has left out since. Rows of a key must arrive in time order across batches, as the
messages of a key do; within a batch they are ordered here, whatever chunks they come in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from readmill.operators.monitor import FALLBACK_WINDOW_S

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Throttle(StatefulProcessor):
    def __init__(self, keys: Sequence[str], seconds: str, window_s: int) -> None:
        self._keys, self._seconds, self._window_s = list(keys), seconds, window_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType(
            [T.StructField("last", T.LongType()), T.StructField("left_out", T.LongType())]
        )
        self._state = handle.getValueState("report", schema)

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        known = self._state.get() if self._state.exists() else None
        last, left_out = (int(known[0]), int(known[1])) if known else (None, 0)
        # All chunks of the key first: one count per second, not the rows themselves.
        counts: Counter[int] = Counter()
        for chunk in rows:
            counts.update(chunk[self._seconds].value_counts().to_dict())
        reports = []
        for second, n in sorted(counts.items()):
            if last is None or second - last >= self._window_s:
                reports.append((*key, second, left_out))
                last, left_out = second, n - 1
            else:
                left_out += n
        if reports:
            yield pd.DataFrame(reports, columns=[*self._keys, self._seconds, "suppressed"])
        self._state.update((last, left_out))

    def close(self) -> None:
        pass


def fallback_report_stream(
    fallbacks: DataFrame, keys: Sequence[str], seconds: str, window_s: int = FALLBACK_WINDOW_S
) -> DataFrame:
    """Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``)."""
    narrow = fallbacks.select(*keys, F.col(seconds).cast("bigint").alias(seconds))
    fields = [narrow.schema[k] for k in keys]
    schema = T.StructType(
        [*fields, T.StructField(seconds, T.LongType()), T.StructField("suppressed", T.LongType())]
    )
    return narrow.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Throttle(keys, seconds, window_s),
        outputStructType=schema,
        outputMode="append",
        timeMode="None",
    )

"""Arrow batches of bounded size for the operators that run Python in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from readmill.session import ship_library

#: Rows of one Arrow batch, so that a batch of long texts still fits a worker.
BATCH_ROWS = 1_000
#: Characters handled at once within a batch; a single longer text is handled alone.
BATCH_CHARS = 4_000_000


def map_arrow(df: DataFrame, task, schema: str) -> DataFrame:
    """``mapInArrow`` over small batches."""
    ship_library(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(task, schema)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batch with their texts; a NULL text is empty."""
    texts = batch.column(column).to_pylist()
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held > BATCH_CHARS or i + 1 == len(texts):
            yield batch.slice(start, i + 1 - start), [t or "" for t in texts[start : i + 1]]
            start, held = i + 1, 0


def groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each group of a partition that is sorted by integer ``columns``."""
    key, parts = None, []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
        ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        cuts = [0, *ends.tolist(), len(keys)]
        for begin, end in zip(cuts, cuts[1:]):
            if end == begin:
                continue
            now = tuple(keys[begin].tolist())
            if now != key and parts:
                yield key, pa.Table.from_batches(parts)
                parts = []
            key = now
            parts.append(batch.slice(begin, end - begin))
    if parts:
        yield key, pa.Table.from_batches(parts)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node it reaches over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new

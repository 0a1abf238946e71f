"""Fallback reports and positions that streams leave beside their tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from readmill.operators import monitor
from readmill.plans.batch import Settings
from readmill.plans.projections import get_projection
from readmill.sources.envelopes import file_stream, replay
from readmill.streaming import offsets
from readmill.streaming.fallbacks import FallbackReports
from readmill.streaming.runner import Store, batch_writer, run_available
from tests.helpers import messages

TICKS = "topic string, edge_id string, row_key string, second bigint, n bigint"


def plain(events, window, keep):
    """Reports of (key, second) in the order given, and the state left."""
    state, out = {}, []
    for key, second in events:
        last, left = state.get(key, (None, 0))
        if last is None or second - last >= window:
            out.append((key, second, 0 if last is not None and second - last > keep else left))
            state[key] = (second, 0)
        else:
            state[key] = (last, left + 1)
    return sorted(out), state


def ticks(spark, events):
    counts = {}
    for key, second in events:
        counts[key, second] = counts.get((key, second), 0) + 1
    return spark.createDataFrame([("t", "e", k, s, n) for (k, s), n in counts.items()], TICKS)


def rows(reports):
    return sorted((r.row_key, r.second, r.suppressed) for r in reports.read().collect())


@pytest.mark.parametrize("keep", [60, 200, 10_000])
def test_reports_over_batches_equal_one_pass(spark, tmp_path, keep):
    rng = random.Random(keep)
    events = sorted(((rng.choice("aaaabc") + str(rng.randrange(3)), rng.randrange(2000)) for _ in range(400)), key=lambda e: e[1])
    expected, state = plain(events, 60, keep)
    reports = FallbackReports(spark, str(tmp_path), "t", 60, keep)
    for batch, start in enumerate(range(0, 400, 100)):
        part = ticks(spark, events[start:start + 100])
        reports.write_batch(part, batch)
        reports.write_batch(part, batch)  # delivered again
    assert rows(reports) == expected
    clock = events[-1][1]
    alive = {k: v for k, v in state.items() if clock - v[0] < 60 or (v[1] > 0 and clock - v[0] <= keep)}
    assert {r.row_key: (r.last, r.left_out) for r in reports.state().collect()} == alive
    assert len(reports._batches()) == 2


def test_empty_batches_nulls_and_odd_topics(spark, tmp_path):
    reports = FallbackReports(spark, str(tmp_path), "t")
    assert reports.read().count() == 0 and reports.state() is None
    reports.write_batch(spark.createDataFrame([], TICKS), 0)
    assert rows(reports) == [] and reports.state().count() == 0
    reports.write_batch(spark.createDataFrame([("t", "e", None, 5, 3), ("t", "e", None, 70, 1)], TICKS), 4)
    assert rows(reports) == [(None, 5, 0), (None, 70, 2)]
    with pytest.raises(ValueError, match="inside the window"):
        FallbackReports(spark, str(tmp_path), "t", 60, 59)


def test_the_runner_reports_and_notes_positions(spark, tmp_path):
    source, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "store"))
    projection, clock = get_projection("cm_state"), F.timestamp_seconds(F.col("offset") * 25)
    bodies = [{"asset_id": "A"}, {"asset_id": "A", "edge_id": "x"}, {"asset_id": "A"}, "broken", {"asset_id": "A", "edge_id": "x", "region_id": "y"}]
    for half in (bodies, bodies[:2]):
        messages(spark, half, projection.topic).coalesce(1).write.mode("append").parquet(source)
        run_available(projection, file_stream(spark, source), store, as_of=clock)
    found = store.fallbacks(projection).read().collect()
    # The second batch starts the clock again: 0 and 25 s lie in windows that are open.
    assert sorted(tuple(r) for r in found) == [
        (projection.topic, "edge-01", "A", 0, 0), (projection.topic, "x", "A", 25, 0)
    ]
    state = {r.edge_id: (r.last, r.left_out) for r in store.fallbacks(projection).state().collect()}
    assert state == {"edge-01": (0, 2), "x": (25, 1)}
    assert [tuple(r) for r in store.consumed().collect()] == [(projection.topic, 0, 5)]
    ends = offsets.ends_of(replay(spark, source)).withColumn("hi", F.lit(9).cast("bigint"))
    read = offsets.stream_offsets(ends, store.consumed(), "g")
    assert [tuple(r) for r in monitor.consumer_lag(read).collect()] == [(projection.topic, 4)]
    # Delivered again, the batch leaves the same reports.
    batch_writer(projection, store, Settings(), clock)(messages(spark, bodies[:2], projection.topic), 1)
    assert sorted(map(tuple, store.fallbacks(projection).read().collect())) == sorted(map(tuple, found))


def test_partitions_nobody_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    ends = spark.createDataFrame([("t", 0, 3, 10)], "topic string, partition int, lo bigint, hi bigint")
    read = offsets.stream_offsets(ends, store.consumed(), "g")
    assert [tuple(r) for r in read.collect()] == [("g", "t", 0, 3, 10, -1001)]
    assert monitor.consumer_lag(read).head().lag == 7


def test_end_marks(spark, tmp_path):
    marks = offsets.EndMarks(spark, str(tmp_path))
    assert marks.read().count() == 0
    for batch in range(20):
        source = {"endOffset": None, "latestOffset": {"t": {"0": batch, "1": 7}}}
        marks.note({"name": "q", "runId": "r", "batchId": batch, "timestamp": f"2024-01-01T00:00:{batch:02d}.000Z", "sources": [source]})
    marks.note({"name": None, "runId": "r", "batchId": 0, "timestamp": "2024-01-01T00:00:00.000Z", "sources": [{"latestOffset": {"logOffset": 1}}]})
    assert sorted(tuple(r) for r in marks.read().collect()) == [("t", 0, None, 19), ("t", 1, None, 7)]
    assert len(list((tmp_path / "end_marks" / "query=q").glob("2024*.json"))) == 16


def test_end_marks_listen_to_streams(spark, tmp_path):
    """A running query reaches the listener; its file source names no partitions, so nothing is written."""
    heard = []

    class Heard(offsets.EndMarks):
        def note(self, progress):
            heard.append(json.dumps(progress))
            super().note(progress)

    listener, source = Heard(spark, str(tmp_path / "marks")), str(tmp_path / "in")
    messages(spark, [{"asset_id": "A"}], "asset-cm-state").write.parquet(source)
    spark.streams.addListener(listener)
    try:
        run_available(get_projection("cm_state"), file_stream(spark, source), Store(spark, str(tmp_path / "store")))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert heard and listener.read().count() == 0

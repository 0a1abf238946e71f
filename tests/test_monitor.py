import random

import pytest
from pyspark.sql import functions as F

from readmill.operators import monitor
from readmill.streaming import throttle
from tests.helpers import as_of

OFFSETS = "group string, topic string, partition int, lo bigint, hi bigint, committed bigint"


def test_lag(spark):
    rows = [("g", "a", 0, 0, 10, 4), ("g", "a", 1, 5, 10, -1001), ("g", "a", 2, 0, 3, 9), ("g", "b", 0, 0, 0, 0)]
    got = {r.topic: r.lag for r in monitor.consumer_lag(spark.createDataFrame(rows, OFFSETS)).collect()}
    assert got == {"a": 11, "b": 0}


def status(spark, offsets, links, group="g"):
    table = spark.createDataFrame(offsets, OFFSETS)
    link = spark.createDataFrame(links, "proxy string, enabled boolean, toxics array<string>")
    return monitor.edge_buffer_status(table, link, group, "hq-link", as_of()).drop("updated_at").collect()


def test_edge_buffer_status(spark):
    offsets = [("g", "tactical-events", 0, 0, 10, 4), ("g", "other", 0, 0, 100, 0), ("h", "tactical-events", 0, 0, 9, 0)]
    up, down = [("hq-link", True, [])], [("hq-link", False, None)]
    assert [tuple(r) for r in status(spark, offsets, up)] == [("edge", 6, False, True)]
    assert [tuple(r) for r in status(spark, offsets, down)] == [("edge", 6, True, True)]
    assert [tuple(r) for r in status(spark, offsets, [("hq-link", True, ["t"])])] == [("edge", 6, True, True)]
    assert [tuple(r) for r in status(spark, offsets, [("x", False, None)])] == [("edge", 6, False, False)]
    assert [tuple(r) for r in status(spark, offsets, down, "none")] == [("edge", -1, True, False)]
    assert [tuple(r) for r in status(spark, [("g", "raw-sensor-stream", 0, 0, 5, 5)], up)] == [("edge", 0, False, True)]


def test_progress_offsets():
    files = {"endOffset": {"logOffset": 3}, "latestOffset": {"logOffset": 4}}
    progress = {"sources": [{"endOffset": {"t": {"0": 5}}, "latestOffset": {"t": {"0": 9, "1": 3}}}, {}, files]}
    assert monitor.progress_offsets(progress, "g") == [("g", "t", 0, None, 9, 5), ("g", "t", 1, None, 3, -1001)]


def test_lag_without_a_low_mark_is_unknown(spark):
    rows = [("g", "a", 0, None, 10, 4), ("g", "a", 1, None, 10, -1001), ("g", "b", 0, None, 10, 4)]
    offsets = spark.createDataFrame(rows, OFFSETS)
    assert {r.topic: r.lag for r in monitor.consumer_lag(offsets).collect()} == {"a": -1, "b": 6}
    assert [tuple(r) for r in status(spark, [("g", "tactical-events", 0, None, 9, -1)], [("hq-link", True, [])])] == [
        ("edge", -1, False, False)
    ]


def greedy(events, window):
    """One report per key and window, counted the plain way."""
    state, out = {}, []
    for key, second in sorted(events, key=lambda e: e[1]):
        last, left_out = state.get(key, (None, 0))
        if last is None or second - last >= window:
            out.append((key, second, left_out))
            state[key] = (second, 0)
        else:
            state[key] = (last, left_out + 1)
    return sorted(out)


@pytest.mark.parametrize("records", [3, 10_000])
def test_fallback_report_equals_greedy(spark, records):
    """Keys may span several Arrow batches; one key holds a third of the rows."""
    rng = random.Random(records)
    events = [(rng.choice("aaabcde"), rng.randrange(3000)) for _ in range(2000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        df = spark.createDataFrame(events, "k string, second bigint")
        got = sorted(tuple(r) for r in monitor.fallback_report(df, ["k"], "second").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == greedy(events, 60)


def test_fallback_report_boundary(spark):
    df = spark.createDataFrame([("a", s) for s in (0, 1, 59, 60, 61, 119, 120, 500)], "k string, second bigint")
    got = [tuple(r) for r in monitor.fallback_report(df, ["k"], "second").orderBy("second").collect()]
    assert got == [("a", 0, 0), ("a", 60, 2), ("a", 120, 2), ("a", 500, 0)]


def test_streaming_report_carries_state(spark, tmp_path):
    rng = random.Random(5)
    events = sorted(((rng.choice("aab"), rng.randrange(1000)) for _ in range(300)), key=lambda e: e[1])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", throttle.STATE_STORE)
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    try:
        for part in (events[:150], events[150:]):
            spark.createDataFrame(part, "k string, second bigint").coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema("k string, second bigint").parquet(source)
            report = throttle.fallback_report_stream(stream, ["k"], "second")
            query = (report.writeStream.format("parquet").option("path", sink)
                     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
            query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    assert got == greedy(events, 60)


def test_outcome_counters(spark):
    rows = [("t", "written")] * 3 + [("t", "DecodeError"), ("t", "skipped"), ("t", "write_error")]
    df = spark.createDataFrame(rows, "topic string, outcome string")
    got = {(r.metric, r.label): r.value for r in monitor.outcome_counters(df, "tab").collect()}
    assert got == {("messages_consumed", "t"): 6, ("rows_written", "tab"): 3,
                   ("decode_errors", "t:DecodeError"): 1, ("write_errors", "write:tab"): 1}


def test_a_key_may_span_chunks_of_a_batch(spark):
    """The streaming throttle sees one key in several chunks, out of order."""
    import pandas as pd

    from readmill.streaming.throttle import _Throttle

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    throttle = _Throttle(["k"], "second", 60)
    throttle._state = State()
    chunks = [pd.DataFrame({"second": [100, 130]}), pd.DataFrame({"second": [0, 10, 10]})]
    found = pd.concat(throttle.handleInputRows(("a",), iter(chunks), None))
    assert found[["second", "suppressed"]].values.tolist() == [[0, 0], [100, 2]]
    assert throttle._state.value == (100, 1)

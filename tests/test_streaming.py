import json

import pytest
from pyspark.sql import functions as F

from readmill.plans.projections import get_projection
from readmill.sources.envelopes import file_stream, replay
from readmill.streaming.runner import Store, batch_writer, run_available, table_schema
from tests.helpers import as_of, messages
from workload import messages as M


def feed(spark, path, bodies, topic):
    messages(spark, bodies, topic).coalesce(1).write.mode("append").parquet(path)


def test_upsert_stream_restarts_and_replays(spark, tmp_path):
    source, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "store"))
    projection = get_projection("cm_state")
    table = store.table(projection, table_schema(spark, projection))
    first = [{"asset_id": "A", "baseline_id": "1"}, {"asset_id": "A", "baseline_id": "2"}, "broken", None]
    second = [{"asset_id": "A", "baseline_id": "3"}, {"asset_id": "B", "baseline_id": "1"}]
    for bodies in (first, second):
        feed(spark, source, bodies, projection.topic)
        run_available(projection, file_stream(spark, source, topic=projection.topic), store, as_of=as_of())
    expected = {"A": "3", "B": "1"}
    assert {r.asset_id: r.baseline_id for r in table.read().collect()} == expected

    # The first batch is delivered again, as after a crash before its commit.
    batch_writer(projection, store, as_of=as_of())(messages(spark, first, projection.topic), 0)
    assert {r.asset_id: r.baseline_id for r in table.read().collect()} == expected

    failures = spark.read.parquet(store.quarantine_path()).collect()
    assert sorted(r.detail for r in failures) == ["message without a value", "value is not JSON text"]
    assert bytes(next(r.value for r in failures if r.value is not None)) == b"broken"
    counters = {(r.batch_id, r.metric): r.value for r in spark.read.parquet(store.metrics_path()).collect()}
    assert counters == {(0, "messages_consumed"): 4, (0, "rows_written"): 1, (0, "decode_errors"): 2,
                        (1, "messages_consumed"): 2, (1, "rows_written"): 2}


def test_event_stream_ignores_redelivery(spark, tmp_path):
    source, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "store"))
    projection = get_projection("tactical_events")
    event = lambda i, subject: {"id": i, "source": "s", "type": "t", "subject": subject, "time": f"2024-01-0{i}T00:00:00Z"}
    for bodies in ([event("1", "a"), event("2", "a"), event("1", "b")], [event("2", "late"), event("3", "a")]):
        feed(spark, source, bodies, projection.topic)
        run_available(projection, file_stream(spark, source), store, as_of=as_of())
    log = store.table(projection, table_schema(spark, projection))
    assert {(r.id, r.subject) for r in log.read().collect()} == {("1", "a"), ("2", "a"), ("3", "a")}
    assert json.loads(log.read().filter("id = '3'").select(F.to_json("data")).head()[0]) == {}
    assert replay(spark, source, projection.topic).count() == 5


def test_parts_of_the_event_stream_grow_in_files(spark, tmp_path, monkeypatch):
    rows = spark.range(2_000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id % 7 as user_id", "'t' as event_type", "1.0D as value", "'{}' as props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(M, "ROWS_PER_FILE", 50)
    assert M.splits_of(rows) == 10
    batches = []

    def note(batch, _):
        first, last = batch.selectExpr("min(p)", "max(p)").first()
        batches.append((first, last, batch.count(), len(batch.select(F.input_file_name()).distinct().collect())))

    stream = M.event_stream(spark, str(tmp_path)).withColumn("p", F.expr(f"((event_id * 7919) % 1000003) * {M.PARTS} div 1000003"))
    stream.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [(first, last, files) for first, last, _, files in batches] == [(k, k, 10) for k in range(M.PARTS)]
    assert sum(n for *_, n, _ in batches) == 2_000


def test_a_failing_batch_fails_the_query(spark, tmp_path):
    source, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "store"))
    projection = get_projection("cm_state")
    feed(spark, source, [{"asset_id": "A"}], projection.topic)
    (tmp_path / "store").mkdir()
    (tmp_path / "store" / "tables").write_text("not a folder")
    with pytest.raises(Exception):
        run_available(projection, file_stream(spark, source), store, as_of=as_of())

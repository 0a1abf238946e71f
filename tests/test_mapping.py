import copy

import pytest
from pyspark.sql import functions as F

from readmill.plans.batch import Settings, project_messages, read_model
from readmill.plans.mapping import configured_projections
from readmill.plans.projections import get_projection, table_columns
from readmill.sources.envelopes import file_stream
from readmill.streaming.runner import Store, run_available, table_schema
from tests.helpers import as_of, messages

FUEL = {
    "name": "fuel", "topic": "fuel-status", "table": "fuel_state", "consumer_group": "any",
    "key": {"column": "asset_id", "path": "asset.asset_id"},
    "fields": {
        "grade": "tank.grade",
        "litres": {"path": "tank.litres", "rule": "number"},
        "refills": {"path": "tank.refills", "rule": "whole"},
        "state": {"path": "state", "rule": "enum", "names": {"1": "OPEN"}, "default": "UNKNOWN"},
        "lasts": {"path": "lasts", "rule": "seconds"},
        "valves": {"path": "valves", "rule": "list"},
    },
    "origin": {"kind": "fieldwise", "block": "provenance"},
    "asset_ttl_hours": 24,
}


def changed(**more):
    return copy.deepcopy(FUEL) | more


def test_fields_become_columns(spark):
    projection = configured_projections([FUEL])["fuel"]
    bodies = [
        {"asset": {"asset_id": "A"}, "tank": {"grade": "x", "litres": "2.5", "refills": 3}, "state": 1, "valves": [1, 2],
         "lasts": "90s", "provenance": {"edge_id": "e"}},
        {"tank": {"refills": "many"}},
        {"asset": {}, "tank": None},
        {"asset": {"asset_id": "B"}, "lasts": "inf"},
        {"asset": {"asset_id": "C"}, "tank": {"refills": 99999999999999999999}},
    ]
    df = project_messages(messages(spark, bodies, "fuel-status"), projection, Settings(), as_of())
    assert table_columns(projection, df) == [
        "asset_id", "grade", "litres", "refills", "state", "lasts", "valves", "updated_at", "edge_id", "region_id"
    ]
    rows = df.withColumn("valves", F.to_json("valves")).drop("updated_at").orderBy("offset").collect()
    assert [r.outcome for r in rows] == ["written", "handler_exception", "written", "handler_exception", "write_error"]
    first = rows[0].asDict()
    assert {k: first[k] for k in ("asset_id", "grade", "litres", "refills", "state", "lasts", "valves", "edge_id", "region_id")} == {
        "asset_id": "A", "grade": "x", "litres": 2.5, "refills": 3, "state": "OPEN", "lasts": 90, "valves": "[1,2]",
        "edge_id": "e", "region_id": "region-01",
    }
    assert rows[1].handler_error == "tank.refills is not a whole number"
    # Without an id in the message its key counts; defaults are those of the rules.
    assert (rows[2].asset_id, rows[2].state, rows[2].valves, rows[2].grade) == ("key-1", "UNKNOWN", "[]", None)


def test_messages_without_any_key_are_skipped(spark):
    projection = configured_projections([FUEL])["fuel"]
    sent = messages(spark, [{"tank": {}}, {"asset": {"asset_id": "A"}}], "fuel-status", keys=[None, ""])
    assert [r.outcome for r in project_messages(sent, projection, Settings(), as_of()).orderBy("offset").collect()] == ["skipped", "written"]
    assert [r.asset_id for r in read_model(sent, projection, Settings(), as_of()).collect()] == ["A"]


def test_a_handler_keeps_its_key_under_another_name(spark):
    entry = {"name": "fleet", "handler": "telemetry_latest", "topic": "t2", "table": "fleet"}
    projection = configured_projections([entry])["fleet"]
    assert (projection.topic, projection.table, projection.asset_ttl_hours) == ("t2", "fleet", None)
    sent = messages(spark, [{"asset": {"asset_id": "A"}}], "t2", keys=["other"])
    assert [r.asset_id for r in read_model(sent, projection, Settings(), as_of()).collect()] == ["A"]


def test_limits_and_their_override():
    log = {"handler": "tactical_events", "topic": "t", "table": "log", "mode": "append", "retention_hours": 48}
    made = configured_projections([FUEL, log])
    assert (made["fuel"].asset_ttl_hours, made["tactical_events"].retention_hours) == (24, 48)
    made = configured_projections([FUEL, log], ttl_override=6)
    assert (made["fuel"].asset_ttl_hours, made["tactical_events"].retention_hours) == (6, 48)
    assert configured_projections([FUEL], ttl_override=0)["fuel"].asset_ttl_hours is None
    assert configured_projections([changed(asset_ttl_hours=None)])["fuel"].asset_ttl_hours is None
    assert get_projection("tactical_events").retention_hours == 24


def test_a_configured_event_log_streams(spark, tmp_path):
    entry = {
        "name": "calls", "topic": "calls", "table": "calls", "mode": "append", "retention_hours": 1,
        "key": {"column": "id"}, "fields": {"time": {"path": "at", "rule": "instant"}, "who": "caller.name"},
    }
    projection, store = configured_projections([entry])["calls"], Store(spark, str(tmp_path / "store"))
    bodies = [{"id": "1", "at": "2024-01-01T00:00:00Z", "caller": {"name": "x"}}, {"id": "1", "at": "2024-01-02T00:00:00Z"}, {"id": "2"}]
    messages(spark, bodies, "calls").coalesce(1).write.parquet(str(tmp_path / "in"))
    run_available(projection, file_stream(spark, str(tmp_path / "in")), store, as_of=as_of())
    rows = store.table(projection, table_schema(spark, projection)).read().collect()
    assert sorted((r.id, r.who, r.time is None) for r in rows) == [("1", "x", False), ("2", None, True)]


@pytest.mark.parametrize(
    "entry, text",
    [
        ({"handler": "nobody"}, "unknown projection"),
        ({"handler": "cm_state", "mode": "append"}, "is an upsert projection"),
        ({"handler": "cm_state", "fields": {}}, "does not know fields"),
        (changed(topic=""), "topic must be a text"),
        ({k: v for k, v in FUEL.items() if k != "table"}, "table is missing"),
        (changed(table="a/b"), "slash"),
        (changed(mode="replace"), "must be upsert or append"),
        (changed(mode="append"), "needs a field time"),
        (changed(asset_ttl_hours=-1), "whole number of hours"),
        (changed(asset_ttl_hours=True), "whole number of hours"),
        (changed(key={"column": "outcome"}), "key column cannot be"),
        (changed(key={"column": "asset_id", "path": "a..b"}), "no usable path"),
        (changed(key=None), "key must be a mapping"),
        (changed(fields={"x": {"path": "a", "rule": "guess"}}), "rule 'guess'"),
        (changed(fields={"x": {"path": "a", "names": {}}}), "does not know names"),
        (changed(fields={"offset": "a"}), "made by the library"),
        (changed(fields={"asset_id": "a"}), "is the key and a field"),
        (changed(fields={"x": "$.a"}), "no usable path"),
        (changed(fields={"x": 3}), "must be a path or a mapping"),
        (changed(origin={"kind": "guess"}), "of kind 'guess'"),
        (changed(origin={"kind": "fieldwise", "position": {"lat": "a", "lon": "b"}}), "kind pair has a position"),
        (changed(extra=1), "does not know extra"),
        ({"topic": "t"}, "needs a name"),
        ("fuel", "must be a mapping"),
    ],
)
def test_wrong_entries_stop_the_load(entry, text):
    with pytest.raises(ValueError, match=text):
        configured_projections([entry])


def test_names_and_tables_are_unique():
    with pytest.raises(ValueError, match="name fuel is given twice"):
        configured_projections([FUEL, changed(table="other")])
    with pytest.raises(ValueError, match="table fuel_state is given twice"):
        configured_projections([FUEL, changed(name="other")])

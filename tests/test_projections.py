import json

import pytest
from pyspark.sql import functions as F

from readmill.operators import assignment as A
from readmill.operators.explode import explode_capabilities, explode_elements
from readmill.operators.provenance import Resolver
from readmill.plans.batch import Settings, blobs_as_json, project_messages, read_model
from readmill.plans.projections import PROJECTIONS, get_projection
from tests.helpers import AS_OF_US, as_of, messages, one, projected

SITES = [A.Site("f1", "r1", 10, 20, "one"), A.Site("f2", "r2", 10, 40, "two")]
NEAR = Settings(resolver=Resolver(A.with_fallback(A.chain(A.longest_prefix({"L-": ("lp", "lr")}), A.nearest_site(SITES)))))
SITE_PAIR = {"edge_id": "edge-01", "region_id": "region-01"}
UNKNOWN = {"edge_id": "edge-unspecified", "region_id": "region-unspecified"}


def check(row, **expected):
    for name, value in expected.items():
        got = row[name]
        if isinstance(value, (list, dict)):
            got = json.loads(got)
        assert got == value, name


def test_registry():
    assert len(PROJECTIONS) == 11
    assert {p.topic for p in PROJECTIONS.values()} == {
        "asset-cm-state", "asset-logistics-status", "telemetry-latest-state", "tactical-events",
        "asset-telemetry-windows", "region-fleet-summary", "region-top-factors", "region-wear-trends",
        "asset-capability-snapshot", "asset-element-telemetry", "asset-element-inventory"}
    with pytest.raises(KeyError, match="cm_state"):
        get_projection("nope")


def test_cm_state(spark):
    body = {"asset_id": "A", "baseline_id": "b", "lifecycle": 2, "overall_status": 4, "last_alerted_status": 77,
            "as_of_ns": 1801627506123456789, "last_observed_at_ns": 0, "installed": [{"slot_id": "s"}],
            "mod_status": None, "edge_id": "e9", "region_id": "", "unknown": 1}
    check(one(spark, "cm_state", body), outcome="written", asset_id="A", baseline_id="b",
          lifecycle="LIFECYCLE_ACTIVE", overall_status="CONFIG_STATUS_NOT_MISSION_CAPABLE",
          last_alerted_status="77", as_of=1801627506123457, last_observed_at=None,
          installed=[{"slot_id": "s"}], mod_status="null", discrepancies=[], manual_discrepancies=[],
          edge_id="e9", region_id="region-01", provenance_fallback=True, updated_at=AS_OF_US)
    check(one(spark, "cm_state", {}), asset_id="key-1", lifecycle="LIFECYCLE_UNSPECIFIED",
          overall_status="CONFIG_STATUS_UNSPECIFIED", last_alerted_status=None, as_of=None, **SITE_PAIR)
    check(one(spark, "cm_state", {"lifecycle": "NAMED", "edge_id": "e", "region_id": "r"}),
          lifecycle="NAMED", edge_id="e", region_id="r", provenance_fallback=False)
    check(one(spark, "cm_state", {"as_of_ns": 10**24}), outcome="handler_exception")
    enums = Settings(enums={"lifecycle": {}, "status": {1: "OK"}})
    check(one(spark, "cm_state", {"lifecycle": 2, "overall_status": 1}, settings=enums),
          lifecycle="2", overall_status="OK")
    assert projected(spark, "cm_state", [{"asset_id": ""}], keys=[""])[0]["outcome"] == "skipped"
    assert projected(spark, "cm_state", [{"asset_id": "x"}], keys=[None])[0]["outcome"] == "written"


def test_logistics_status(spark):
    body = {"status": {"asset_id": "A", "platform_variant": "v", "overall_severity": "RED",
                       "constraining_factors": [{"factor_id": "f"}],
                       "projected_mission_capable_remaining": "120s", "projected_time_to_next_constraint": "3.5s",
                       "cm_baseline_id": "b", "status_revision": "91", "computed_at": "2027-02-03T04:05:06Z"},
            "previous_severity": "AMBER", "is_transition": True, "provenance": {"edge_id": "e", "region_id": "r"}}
    check(one(spark, "logistics_status", body, settings=NEAR), asset_id="A", platform_variant="v",
          overall_severity="RED", previous_severity="AMBER", constraining_factors=[{"factor_id": "f"}],
          projected_mission_capable_remaining_seconds=120, projected_time_to_next_constraint_seconds=3,
          cm_baseline_id="b", status_revision=91, computed_at=1801627506000000,
          latest_telemetry_sample_time=None, is_transition=True, is_initial=False, edge_id="e", region_id="r")
    check(one(spark, "logistics_status", {"status": None, "is_initial": "no"}), asset_id="key-1",
          overall_severity="LOGISTICS_SEVERITY_UNSPECIFIED", constraining_factors=[], status_revision=0,
          is_initial=True, **UNKNOWN)
    check(one(spark, "logistics_status", {"status": {"overall_severity": None}}), overall_severity=None)
    check(one(spark, "logistics_status", {"status": {"asset_id": "L-7"}, "provenance": {"edge_id": "only"}}, settings=NEAR),
          edge_id="lp", region_id="lr")
    for broken in ({"status": "x"}, {"status": {}, "provenance": [1]}, {"status": {"status_revision": [1]}},
                   {"status": {"projected_time_to_next_constraint": "inf"}}):
        check(one(spark, "logistics_status", broken), outcome="handler_exception")


def test_telemetry_latest(spark):
    body = {"asset": {"asset_id": "A", "callsign": "c", "platform_variant": "v", "force": "FORCE_FRIENDLY"},
            "kinematics": {"position": {"wgs84": {"lat": {"value": 10.1, "unit": "deg"}, "lon": {"value": 38}}}},
            "sustainment": {"fuel": 1}, "schema_revision": 3,
            "provenance": {"producer_id": "maker-3", "sample_time": "2027-02-03T04:05:06Z"},
            "operational_state": {"power_state": "ON", "health_state": "OK", "actively_receiving": False}}
    check(one(spark, "telemetry_latest", body, settings=NEAR), asset_id="A", callsign="c", force_id="FORCE_FRIENDLY",
          edge_id="f2", region_id="r2", sustainment={"fuel": 1}, last_sample_at=1801627506000000,
          schema_revision=3, power_state="ON", functional_mode=None, health_state="OK",
          actively_receiving=False, actively_transmitting=None,
          provenance={"producer_id": "maker-3", "sample_time": "2027-02-03T04:05:06Z"})
    own = body | {"provenance": {"edge_id": "e", "region_id": "r"}}
    check(one(spark, "telemetry_latest", own, settings=NEAR), edge_id="e", region_id="r")
    check(one(spark, "telemetry_latest", {}, settings=NEAR), asset_id="key-1", kinematics=None, provenance={},
          schema_revision=0, power_state=None, **UNKNOWN)
    for broken in ({"asset": "x"}, {"kinematics": {"position": "x"}}, {"operational_state": "x"}, {"schema_revision": "x"}):
        check(one(spark, "telemetry_latest", broken), outcome="handler_exception")


def test_tactical_events(spark):
    body = {"id": "1", "source": "s", "type": "t", "subject": "A", "time": "2027-02-03T04:05:06Z",
            "data": {"current_status": "DOWN", "edge_id": "e", "region_id": "r"}}
    check(one(spark, "tactical_events", body), id="1", source="s", type="t", subject="A", severity="DOWN",
          time=1801627506000000, edge_id="e", region_id="r", ingested_at=AS_OF_US, provenance_fallback=False)
    bare = {"id": "1", "source": "s", "type": "t"}
    check(one(spark, "tactical_events", bare), subject="key-1", severity=None, time=None, data={}, **SITE_PAIR)
    check(one(spark, "tactical_events", bare | {"data": None}), data="null")
    check(one(spark, "tactical_events", bare | {"data": "x", "severity": "hi"}), data='"x"', severity="hi", **SITE_PAIR)
    assert projected(spark, "tactical_events", [bare], keys=[None])[0]["subject"] == ""


def test_telemetry_windows(spark):
    body = {"asset_id": "A", "platform_variant": "v", "fluid_trends": {"oil": {"slope": 1}},
            "consumable_trends": [{"slot": 1}], "wear_trends": [{"component": "c"}],
            "window": {"sample_count": "12", "window_duration": "60s"}, "computed_at": "2027-02-03",
            "provenance": {"edge_id": "e"}}
    check(one(spark, "telemetry_windows", body), asset_id="A", fluid_trends={"oil": {"slope": 1}},
          consumable_trends=[{"slot": 1}], component_wear_trends=[{"component": "c"}],
          window_duration_seconds=60, sample_count=12, computed_at=1801612800000000,
          edge_id="e", region_id="region-01")
    check(one(spark, "telemetry_windows", {"window": {"duration": "5s", "window_duration": "60s"}}),
          window_duration_seconds=5, sample_count=None, fluid_trends=[])
    for broken in ({"window": "x"}, {"window": {"sample_count": ""}}, {"provenance": 5}):
        check(one(spark, "telemetry_windows", broken), outcome="handler_exception")


def test_regions(spark):
    body = {"region_id": "R", "nominal": 3, "degraded": "2", "critical": None, "observed_at": "2027-02-03T04:05:06Z"}
    check(one(spark, "region_fleet_summary", body), region_id="R", nominal=3, degraded=2, critical=0,
          non_operational=0, asset_count=0, observed_at=1801627506000000)
    check(one(spark, "region_fleet_summary", {"nominal": "x"}), outcome="handler_exception")
    factors = [{"factor_id": "a", "count": 1}, {"factor_id": "b", "count": 9}]
    check(one(spark, "region_top_factors", {"factors": factors}), region_id="key-1", factors=factors)
    check(one(spark, "region_top_factors", {"factors": None}), factors=[])
    repeated = [{"component_id": "c", "unit": "km"}, {"component_id": "c", "unit": "h"}]
    check(one(spark, "region_wear_trends", {"components": repeated}), components=repeated)


def test_capability_state(spark):
    body = {"asset_id": "L-1", "capabilities": [{"store": "x"}], "schema_version": "1.0", "mode": "m",
            "observed_at": "2027-02-03T04:05:06Z"}
    check(one(spark, "capability_state", body, settings=NEAR), asset_id="L-1", capabilities=[{"store": "x"}],
          schema_version="1.0", mode="m", observed_at=1801627506000000, edge_id="lp", region_id="lr")
    check(one(spark, "capability_state", {}, settings=NEAR), capabilities=[], **UNKNOWN)


def test_element_telemetry(spark):
    elements = [{"element_id": "e1", "layer_depth": 2, "temp_c": 3.5, "tx_active": True}, {"element_id": "e2"}]
    body = {"asset_id": "L-1", "platform_variant": "v", "observed_at_ns": -1500, "elements": elements,
            "operational": {"power_state": "ON"}, "provenance": {"edge_id": "e", "region_id": "r"}}
    check(one(spark, "asset_element_telemetry", body, settings=NEAR), asset_id="L-1", platform_variant="v",
          profile_name="", elements=elements, operational={"power_state": "ON"}, observed_at=-2,
          edge_id="lp", region_id="lr")
    check(one(spark, "asset_element_telemetry", {}), elements=[], operational={}, observed_at=AS_OF_US)
    check(one(spark, "asset_element_telemetry", {"elements": {"a": 1}}), outcome="skipped")
    check(one(spark, "asset_element_telemetry", {"elements": {}}), outcome="written")

    topic = messages(spark, [body])
    rows = read_model(topic, get_projection("asset_element_telemetry"), as_of=as_of())
    exploded = [tuple(r) for r in explode_elements(rows).orderBy("position").collect()]
    assert exploded == [("L-1", 0, "e1", 2, None, None, 3.5, None, True, None),
                        ("L-1", 1, "e2", None, None, None, None, None, None, None)]


def test_explode_capabilities(spark):
    topic = messages(spark, [{"asset_id": "A", "capabilities": [{"s": 1}, None, 7]}])
    rows = explode_capabilities(read_model(topic, get_projection("capability_state")))
    got = blobs_as_json(rows, ("capability",)).orderBy("position").collect()
    assert [(r.position, r.capability) for r in got] == [(0, '{"s":1}'), (1, None), (2, "7")]


def test_inventory(spark):
    body = {"asset_id": " depot\t", "layer_name": "\nrack ", "available_count": 91.7, "allocated_count": "91.7", "total_count": 5}
    check(one(spark, "asset_element_inventory", body), id="depot:rack", name="rack", layer_name="rack",
          asset_id="depot", available_count=91, allocated_count=0)
    for skipped in ({"layer_name": "x"}, {"asset_id": "x", "layer_name": "  "}, {"asset_id": None, "layer_name": "x"}):
        check(one(spark, "asset_element_inventory", skipped), outcome="skipped")
    check(one(spark, "asset_element_inventory", {"asset_id": 5, "layer_name": "x"}), outcome="handler_exception")


def test_coalesce_modes(spark):
    """By row key the last good row counts; by message key a bad last message hides it."""
    bodies = [{"asset_id": "A", "baseline_id": "1"}, {"asset_id": "A", "baseline_id": "2"}, "broken"]
    topic = messages(spark, bodies)
    projection = get_projection("cm_state")
    assert [r.baseline_id for r in read_model(topic, projection).collect()] == ["2"]
    assert read_model(topic, projection, Settings(coalesce="message_key")).count() == 0
    with pytest.raises(ValueError):
        project_messages(topic, projection, Settings(coalesce="other"))


def test_messages_without_key_collapse_in_strict_mode(spark):
    topic = messages(spark, [{"asset_id": "A"}, {"asset_id": "B"}], keys=[None, None])
    rows = read_model(topic, get_projection("cm_state"), Settings(coalesce="message_key")).collect()
    assert [r.asset_id for r in rows] == ["B"]


def test_event_log_keeps_first_copy(spark):
    event = {"id": "1", "source": "s", "type": "t"}
    topic = messages(spark, [event | {"subject": "first"}, event | {"subject": "second"}])
    assert [r.subject for r in read_model(topic, get_projection("tactical_events")).collect()] == ["first"]


def test_columns_that_are_not_wanted_are_not_computed(spark):
    bodies = [
        {"asset_id": "a", "elements": [{"element_id": "e1"}], "platform_variant": "old"},
        {"asset_id": "a", "elements": [{"element_id": "e2"}, {}], "platform_variant": "v", "observed_at_ns": "5"},
        {"asset_id": "b", "elements": []}, {"asset_id": "b", "elements": "none"}, "broken", {"elements": [{}]}, None,
        {"asset_id": "c", "elements": [{}], "observed_at_ns": 10**30},
    ]
    projection = get_projection("asset_element_telemetry")
    sent = messages(spark, bodies, projection.topic)
    whole = read_model(sent, projection, as_of=as_of())
    narrow = read_model(sent, projection, as_of=as_of(), only=("elements",))
    assert narrow.columns == ["asset_id", "elements"]
    text = lambda df: sorted(tuple(r) for r in df.select("asset_id", F.to_json("elements")).collect())
    assert text(narrow) == text(whole) and len(text(whole)) >= 3
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "platform_variant" not in plan and "platform_variant" in whole._jdf.queryExecution().optimizedPlan().toString()

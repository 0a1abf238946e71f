import json

import pytest
from pyspark.sql import functions as F

from readmill.operators import decode as D
from readmill.operators import quarantine as Q
from tests.helpers import messages, projected

BAD = [
    (None, "message without a value"),
    (b"\xff\xfe", "value is not JSON text"),
    ("not json", "value is not JSON text"),
    ("", "value is not JSON text"),
    ('{"a":1} x', "value is not JSON text"),
    ('{"a":1}}', "value is not JSON text"),
    ('{"a":1}]', "value is not JSON text"),
    ('{"a":1},{"b":2}', "value is not JSON text"),
    ('{"a":1}],[{"a":1}', "value is not JSON text"),
    ('{"a":1}{"a":2}', "value is not JSON text"),
    ('{"a":1,}', "value is not JSON text"),
    ("[1,2,3]", "JSON value is a list, expected object"),
    ('"str"', "JSON value is a str, expected object"),
    ("null", "JSON value is a NoneType, expected object"),
    ("true", "JSON value is a bool, expected object"),
    ("12", "JSON value is a int, expected object"),
    (" 1.5", "JSON value is a float, expected object"),
]
GOOD = ['{"a":1}', ' \n{"a":1}\t', "{}", '{"a":1,"a":2}', '{"a":"é \\" }"}', '{"a":{"b":[1,{}]}}']


def test_json_objects(spark):
    df = D.decode_json(messages(spark, [b for b, _ in BAD] + GOOD))
    rows = df.select("offset", "decode_error", F.to_json("v").alias("v")).orderBy("offset").collect()
    assert [r.decode_error for r in rows[: len(BAD)]] == [e for _, e in BAD]
    assert all(r.v is None for r in rows[: len(BAD)])
    assert all(r.decode_error is None for r in rows[len(BAD):])
    assert [json.loads(r.v) for r in rows[len(BAD):]] == [json.loads(t) for t in GOOD]


@pytest.mark.parametrize(
    "body, missing",
    [
        ({"id": "x", "source": "s", "type": "t"}, None),
        ({"id": "x", "source": "s"}, "type"),
        ({"id": "", "source": "s", "type": "t"}, "id"),
        ({"id": 0, "source": None, "type": []}, "id, source, type"),
        ({}, "id, source, type"),
    ],
)
def test_cloudevents(spark, body, missing):
    row = D.decode_cloudevents(messages(spark, [body])).head()
    expected = missing and f"CloudEvent missing required attribute(s): {missing}"
    assert row.decode_error == expected
    assert (row.v is None) == (missing is not None)


def test_cloudevents_shares_json_rules(spark):
    rows = D.decode_cloudevents(messages(spark, ["[]", "x", None])).orderBy("offset").collect()
    assert [r.decode_error for r in rows] == [
        "CloudEvent envelope is list, expected object", "value is not JSON text", "message without a value"]


def test_dispatch():
    assert D.decoder_for("json") is D.decode_json
    assert D.decoder_for("cloudevents.json") is D.decode_cloudevents
    assert D.decoder_for("WindowedTelemetry") is D.decode_json
    with pytest.raises(ValueError, match="no message type registered"):
        D.decoder_for("Unknown")
    with pytest.raises(ValueError, match="no message type registered"):
        D.decoder_for("Unknown", "file.desc")


def test_durations_take_their_json_form(spark):
    df = spark.sql("""select named_struct('d', interval '0 01:00:03.5' day to second, 'a',
        array(named_struct('e', interval '2' second)), 'n', cast(null as int)) s""")
    form = D.proto_json_form(F.col("s"), df.schema["s"].dataType)
    assert json.loads(df.select(F.to_json(form)).head()[0]) == {"d": "3603.5s", "a": [{"e": "2.0s"}]}


def test_outcomes_and_quarantine(spark):
    bodies = [
        None, "not json", {"status": "text"}, {"status": {"status_revision": "abc"}},
        {"status": {"status_revision": 10**20}}, {}, {"status": {"asset_id": "a"}},
    ]
    keys = ["k"] * 5 + ["", "k"]
    rows = projected(spark, "logistics_status", bodies, keys=keys)
    assert [r["outcome"] for r in rows] == [
        "DecodeError", "DecodeError", "handler_exception", "handler_exception", "write_error", "skipped", "written"]

    from readmill.plans.batch import project_messages
    from readmill.plans.projections import get_projection

    projection = get_projection("logistics_status")
    df = project_messages(messages(spark, bodies, projection.topic, keys), projection)
    failed = Q.quarantined(df)
    assert failed.count() == 5
    assert {(r.signature, r.messages) for r in Q.distinct_failures(failed).collect()} == {
        ("message without a value", 1), ("value is not JSON text", 1), ("status is not an object", 1),
        ("status.status_revision is not a whole number", 1), ("status.status_revision is out of range", 1)}
    assert {(r.outcome, r.messages) for r in Q.outcome_counts(df).collect()} == {
        ("DecodeError", 2), ("handler_exception", 2), ("write_error", 1), ("skipped", 1), ("written", 1)}

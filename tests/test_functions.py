import json
import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from readmill.functions import scalars as S
from readmill.functions import times as TM
from readmill.functions import variants as V
from readmill.functions.geo import great_circle_km


def evaluate(spark, texts, build):
    """Apply ``build`` to the field ``x`` of each JSON text."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    f = V.field(F.parse_json("s"), "x")
    return [r[1] for r in df.select("i", build(f).alias("r")).orderBy("i").collect()]


def wrap(values):
    return ["{}" if v is ... else json.dumps({"x": v}) for v in values]


def micros(moment):
    return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


FALSY = [..., None, "", 0, 0.0, False, [], {}]
TRUTHY = ["0", "false", " ", "[]", 1, -1, 0.5, True, [None], [0], {"a": None}, {"a": 1}]


@pytest.mark.parametrize("rule", [V.truthy, V.truthy_blob, V.truthy_block])
def test_truthiness(spark, rule):
    assert evaluate(spark, wrap(FALSY + TRUTHY), rule) == [False] * len(FALSY) + [True] * len(TRUTHY)


def test_truthy_text_and_first_present(spark):
    assert evaluate(spark, wrap(["a", "", 0, 7, None, ...]), V.truthy_text) == ["a", None, None, "7", None, None]
    df = spark.sql("""select parse_json('{"a":null,"b":0,"c":1}') v""")
    fields = [V.field(F.col("v"), p) for p in ("missing", "a", "b", "c")]
    assert df.select(F.to_json(V.first_present(*fields))).head()[0] == "0"


def test_absent_and_null_defaults(spark):
    default = lambda f: F.to_json(V.or_default(f, "[]"))
    falsy = lambda f: F.to_json(V.or_falsy(f, "[]"))
    values = wrap([..., None, [], [1], {}, "x"])
    assert evaluate(spark, values, default) == ["[]", "null", "[]", "[1]", "{}", '"x"']
    assert evaluate(spark, values, falsy) == ["[]", "[]", "[]", "[1]", "[]", '"x"']


def test_object_and_array_expectations(spark):
    values = wrap([..., None, "", {}, {"e": 1}, {"z": 1}, "text", [1], 5])
    assert evaluate(spark, values, lambda f: V.not_object(f, "e")) == [False] * 6 + [True] * 3
    values = wrap([..., None, [], [None], [1], {}, {"a": 1}, "text"])
    assert evaluate(spark, values, V.not_array) == [False] * 6 + [True] * 2


@pytest.mark.parametrize(
    "value, expected",
    [(91.7, 91), (-91.7, -91), ("91", 91), (" 91 ", 91), ("91.7", 0), (None, 0), (..., 0), ("x", 0),
     (True, 1), ([1], 0), ({}, 0), ("+5", 5), (1e3, 1000), ("", 0)],
)
def test_count_or_zero(spark, value, expected):
    assert evaluate(spark, wrap([value]), S.count_or_zero) == [expected]


def test_integer_errors(spark):
    values = wrap([..., None, "", 0, "12", "abc", "1.5", [1], 2**70, str(2**70), True])
    assert evaluate(spark, values, V.bad_integer) == [False] * 5 + [True] * 3 + [False] * 3
    assert evaluate(spark, values, V.integer_overflow) == [False] * 8 + [True] * 2 + [False]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2027-02-03T03:00:00Z", "2027-02-03T03:00:00+00:00"),
        ("2027-02-03T03:00:00.123456789Z", "2027-02-03T03:00:00.123456+00:00"),
        ("2027-02-03", "2027-02-03T00:00:00+00:00"),
        ("2027-02-03 03:00", "2027-02-03T03:00:00+00:00"),
        ("2027-02-03T03", "2027-02-03T03:00:00+00:00"),
        ("2027-02-03T03+02:00", "2027-02-03T01:00:00+00:00"),
        ("2027-02-03T03:30Z", "2027-02-03T03:30:00+00:00"),
        ("2027-02-03T03:00:00+0530", "2027-02-02T21:30:00+00:00"),
        ("2027-02-03T03:00:00-03:30", "2027-02-03T06:30:00+00:00"),
        ("2027-02-03T03:00:00,5Z", "2027-02-03T03:00:00.500000+00:00"),
        ("", None), ("some day", None), ("2026", None), ("2026-05", None), ("T03:00", None),
        (" 2027-02-03 ", None), ("2026-02-30", None), ("0000-01-01", None), (..., None),
        (None, None), (20260514, None), (True, None),
    ],
)
def test_instant(spark, text, expected):
    got = evaluate(spark, wrap([text]), lambda f: F.unix_micros(TM.instant_field(f)))[0]
    assert got == (None if expected is None else micros(datetime.fromisoformat(expected)))


def python_ns(ns):
    """The rounding a float-based conversion applies."""
    return micros(datetime.fromtimestamp(ns / 1_000_000_000, tz=timezone.utc))


def test_ns_instant_matches_python(spark):
    rng = random.Random(7)
    values = [1801627506123456789, 1801627506123456500, 1, 999, 1500, 253402300799000000000]
    values += [rng.randrange(1, 4_000_000_000_000_000_000) for _ in range(3000)]
    values += [rng.randrange(1, 2_000_000_000_000) * 1000 + 500 for _ in range(3000)]
    values += [(1 << 30) * 10**9 + d for d in range(-2000, 2001, 500)]
    got = evaluate(spark, wrap(values), lambda f: F.unix_micros(TM.ns_instant(f)))
    assert got == [python_ns(v) for v in values]
    as_text = evaluate(spark, wrap([str(v) for v in values[:200]]), lambda f: F.unix_micros(TM.ns_instant(f)))
    assert as_text == got[:200]


def test_ns_instant_edges(spark):
    values = wrap([0, -1, None, ..., "plenty", [], "0"])
    assert evaluate(spark, values, TM.ns_instant) == [None] * 7
    fallback = F.timestamp_micros(F.lit(5))
    any_sign = lambda f: F.unix_micros(TM.ns_instant_or(f, fallback))
    negative = [-1, -1500, -2_500_000_123_456_789, 0]
    assert evaluate(spark, wrap(negative), any_sign) == [python_ns(v) for v in negative]
    assert evaluate(spark, wrap(["x", None, ..., 10**24]), any_sign) == [5] * 4
    assert evaluate(spark, wrap([10**24, 10**18]), TM.ns_out_of_range) == [True, False]


@pytest.mark.parametrize(
    "value, expected",
    [("45s", 45), ("6.25s", 6), ("-6.25s", -6), ("77", 77), ("1e3s", 1000), (7.9, 7), (5, 5), (True, 1),
     ("", None), ("abc", None), (None, None), (..., None), ("nan", None), ("12d", None), ([], None)],
)
def test_duration_seconds(spark, value, expected):
    assert evaluate(spark, wrap([value]), TM.duration_seconds) == [expected]


def test_infinite_duration_is_an_error(spark):
    assert evaluate(spark, wrap(["inf", "-Infinitys", "5s", None]), TM.bad_duration) == [True, True, False, False]


def test_enum_name(spark):
    names = {2: "ACTIVE", 4: "DOWN"}
    rule = lambda f: S.enum_name(f, names, "DEFAULT")
    assert evaluate(spark, wrap([2, 4, 9, "ACTIVE", "2", None, ..., True]), rule) == [
        "ACTIVE", "DOWN", "9", "ACTIVE", "2", "DEFAULT", "DEFAULT", "true"]
    assert evaluate(spark, wrap([2, None]), lambda f: S.enum_name(f, {}, None)) == ["2", None]


@pytest.mark.parametrize(
    "envelope, expected",
    [
        ({"data": {"current_status": "DOWN"}}, "DOWN"),
        ({"data": {"overall_severity": "RED"}}, "RED"),
        ({"severity": "top", "data": {"severity": "low"}}, "top"),
        ({"severity": "", "data": {"severity": "", "overall_status": "x"}}, "x"),
        ({"data": "text"}, None),
        ({}, None),
    ],
)
def test_severity(spark, envelope, expected):
    assert evaluate(spark, wrap([envelope]), S.severity) == [expected]


@pytest.mark.parametrize(
    "kinematics, expected",
    [
        ({"position": {"wgs84": {"latitude": 1.5, "longitude": 2}}}, (1.5, 2.0)),
        ({"position": {"wgs84": {"lat": {"value": 61.125, "unit": "deg"}, "lon": {"value": "-1"}}}}, (61.125, -1.0)),
        ({"position": {"lat": "10", "lon": 20}}, (10.0, 20.0)),
        ({"position": {"wgs84": {}, "lat": 3, "lon": 4}}, (3.0, 4.0)),
        ({"position": {"wgs84": {"latitude": None, "lat": 5, "lon": 6}}}, (5.0, 6.0)),
        ({"position": {"wgs84": {"lat": "north", "lon": 6}}}, (None, None)),
        ({"position": {"wgs84": {"lat": [1], "lon": 6}}}, (None, None)),
        ({"position": {"wgs84": {"lat": {"unit": "deg"}, "lon": 6}}}, (None, 6.0)),
        ({"position": {"wgs84": {"lat": 7}}}, (7.0, None)),
        ({"position": {"wgs84": "text", "lat": 1, "lon": 2}}, (None, None)),
        ({"position": {"ecef": {"x": 1}}}, (None, None)),
        ({}, (None, None)), ("text", (None, None)), (..., (None, None)),
    ],
)
def test_wgs84(spark, kinematics, expected):
    got = evaluate(spark, wrap([kinematics]), lambda f: F.struct(*[c.alias(n) for n, c in zip("ab", S.wgs84(f))]))
    assert tuple(got[0]) == expected


def test_link_severed(spark):
    df = spark.sql("""select * from values (1, true, array('t')), (2, false, null), (3, null, array()),
        (4, true, null), (5, null, array('a')) as t(i, enabled, toxics)""")
    got = df.orderBy("i").select(S.link_severed(F.col("enabled"), F.col("toxics"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, True]


def test_great_circle(spark):
    def km(*args):
        return spark.range(1).select(great_circle_km(*[F.lit(float(a)) for a in args])).head()[0]

    assert 5550 < km(51.5074, -0.1278, 40.7128, -74.0060) < 5590
    assert km(10, 20, 10, 20) == 0
    assert math.isclose(km(0, 0, 0, 180), math.pi * 6371.0088)
    assert math.isclose(km(10.5, 20.5, 10, 20), 78.0018, abs_tol=1e-4)


def test_strip_and_row_id(spark):
    row = spark.sql(r"select '  a\t\n' a, ' b ' b")
    assert row.select(S.row_id(S.strip(F.col("a")), S.strip(F.col("b")))).head()[0] == "a:b"

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import value
from runledger.functions import any_as_string, attr, body_text, body_value, double_text, json_text, resolve_time, rfc3339
from runledger.operators.extract import extract_rows
from runledger.schema import ANY_VALUE, ATTRIBUTES, LOG_RECORD

NESTED = {"a": [{"b": 1}, [], [2.0]], "c": {"d": {}}}

CASES = [
    # any-value, as text, as body
    ({"stringValue": "plain"}, "plain", '"plain"'),
    ({"stringValue": ""}, "", '""'),
    ({"stringValue": '{"tool":"bash"}'}, '{"tool":"bash"}', '"{\\"tool\\":\\"bash\\"}"'),
    ({"boolValue": True}, "true", "true"),
    ({"intValue": "5"}, "5", "5"),
    ({"intValue": 5}, "5", "5"),
    ({"doubleValue": 2.5}, "2.5", "2.5"),
    ({"doubleValue": 2.0}, "2", "2"),
    ({"doubleValue": "NaN"}, "NaN", '{"raw":"NaN"}'),
    ({"doubleValue": "-Infinity"}, "-Inf", '{"raw":"-Inf"}'),
    ({"bytesValue": "aGk="}, "aGk=", '"aGk="'),
    ({}, "", "null"),
    (value([1, "x", None, 2.5]), '[1,"x",null,2.5]', '[1,"x",null,2.5]'),
    ({"arrayValue": {}}, "[]", "[]"),
    ({"kvlistValue": {}}, "{}", "{}"),
    (value({"b": 1, "a": False}), '{"a":false,"b":1}', '{"a":false,"b":1}'),
    (value(NESTED), '{"a":[{"b":1},[],[2]],"c":{"d":{}}}', '{"a":[{"b":1},[],[2]],"c":{"d":{}}}'),
    ({"arrayValue": {"values": [{"doubleValue": "NaN"}]}}, "", '{"raw":""}'),
    (
        {"kvlistValue": {"values": [{"key": "k", "value": {"intValue": "1"}}, {"key": "k", "value": {"intValue": "2"}}]}},
        '{"k":2}',
        '{"k":2}',
    ),
]


def nested(depth, leaf):
    out = leaf
    for i in range(depth):
        out = [out, "x"] if i % 2 else {"k": out, "": i}
    return out


def pairs(*entries):
    return {"kvlistValue": {"values": [{"key": k, "value": v} for k, v in entries]}}


TRICKY = '{"intValue":"5"}, [1] \\ "\\" \u0001 ] } : ,'
CASES += [
    (value(nested(25, [1.5])), None, json.dumps(nested(25, [1.5]), sort_keys=True, separators=(",", ":"))),
    (value({TRICKY: [TRICKY, {TRICKY: [TRICKY]}]}), None, json.dumps({TRICKY: [TRICKY, {TRICKY: [TRICKY]}]}, separators=(",", ":"))),
    (value([[1e10, 2.0, 1e-7, 0.5, -3.0, 1e21]]), "[[10000000000,2,1.0E-7,0.5,-3,1.0E21]]", "[[10000000000,2,1.0E-7,0.5,-3,1.0E21]]"),
    (value([[[{"a": 1}]], [], [{}]]), '[[[{"a":1}]],[],[{}]]', '[[[{"a":1}]],[],[{}]]'),
    # Of a repeated key the last entry stays, at every depth.
    (pairs(("o", pairs(("k", value(1)), ("l", value([2])), ("k", value([3, {"m": 4}])))), ("p", value(5))), None, '{"o":{"k":[3,{"m":4}],"l":[2]},"p":5}'),
    ({"arrayValue": {"values": [{"arrayValue": {"values": [{"doubleValue": "NaN"}]}}]}}, "", '{"raw":""}'),
    ({"arrayValue": {"values": [{"arrayValue": {"values": [{"intValue": "no number"}]}}]}}, "", '{"raw":""}'),
    ({"arrayValue": {"values": [{"kvlistValue": {"values": [{"key": "a"}, {"value": {"boolValue": True}}]}}]}}, None, '[{"":true,"a":null}]'),
    ({"arrayValue": {"values": [{"arrayValue": {"values": [{"arrayValue": None, "intValue": "5", "stringValue": None}, {"boolValue": None}]}}]}}, None, "[[5,null]]"),
    ({"arrayValue": {"values": [{"arrayValue": {"values": [{"bytesValue": "aGk="}, {"intValue": 7}, {"intValue": "-007"}, {}]}}]}}, None, '[["aGk=",7,-7,null]]'),
]


def decoded(spark, values):
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, s string")
    typed = rows.select("i", F.from_json("s", ANY_VALUE).alias("v"))
    both = typed.select("i", any_as_string("v").alias("text"), json_text(body_value("v")).alias("body"))
    return [(r.text, r.body) for r in both.orderBy("i").collect()]


def test_any_values(spark):
    assert decoded(spark, [c[0] for c in CASES]) == [(c[2] if c[1] is None else c[1], c[2]) for c in CASES]


def test_long_nested_values(spark):
    long = value([[{"n": i, "s": "text " * 3} for i in range(3000)], ["y" * 200_000]])
    assert json.loads(decoded(spark, [long])[0][1]) == [[{"n": i, "s": "text " * 3} for i in range(3000)], ["y" * 200_000]]


def test_no_python_in_the_plan(spark):
    flat = spark.createDataFrame([], f"record {LOG_RECORD}")
    text = extract_rows(flat)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_missing_any_value(spark):
    missing = spark.range(1).select(F.lit(None).cast(ANY_VALUE).alias("v"))
    assert missing.select(any_as_string("v"), json_text(body_value("v"))).first() == (None, "null")


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.text(st.characters(codec="utf-8"), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(st.characters(codec="utf-8"), max_size=4), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(json_values, min_size=20, max_size=40))
def test_bodies_keep_their_json(spark, values):
    bodies = [json.loads(b) for _, b in decoded(spark, [value(v) for v in values])]
    assert bodies == values


@pytest.mark.parametrize(
    "number, text",
    [
        (0.0, "0"), (-0.0, "-0"), (1.0, "1"), (-1.5, "-1.5"), (1e10, "10000000000"), (123456789.125, "123456789.125"),
        (1e20, "100000000000000000000"), (1e21, "1e+21"), (1.5e22, "1.5e+22"), (1e-6, "0.000001"), (1e-7, "1e-7"),
        (2.5e-9, "2.5e-9"), (0.1, "0.1"), (100.0, "100"),
    ],
)
def test_double_text(spark, number, text):
    assert spark.createDataFrame([(number,)], "d double").select(double_text("d")).first()[0] == text


def test_first_attribute_counts(spark):
    pairs = [("event", "x"), ("event", "y")]
    text = json.dumps([{"key": k, "value": value(v)} for k, v in pairs])
    rows = spark.createDataFrame([(text,), ("[]",), (None,)], "s string").select(F.from_json("s", ATTRIBUTES).alias("a"))
    found = rows.withColumn("e", attr("a", "event")).withColumn("n", attr("a", "none"))
    assert [r[0] for r in found.select(any_as_string("e")).collect()] == ["x", None, None]
    assert [r[0] for r in found.select(any_as_string("n")).collect()] == [None, None, None]


SECOND = 1_704_067_207_000_000_000


@pytest.mark.parametrize(
    "event, observed, shown",
    [
        (str(SECOND), "0", "2024-01-01T00:00:07Z"),
        (str(SECOND + 500_000_000), "0", "2024-01-01T00:00:07.5Z"),
        (str(SECOND + 123_456_789), str(SECOND), "2024-01-01T00:00:07.123456Z"),  # nanoseconds are cut off
        ("0", str(SECOND), "2024-01-01T00:00:07Z"),
        (None, str(SECOND), "2024-01-01T00:00:07Z"),
        ("0", "0", "2026-01-01T00:00:00Z"),
        (None, None, "2026-01-01T00:00:00Z"),
        ("18446744073709551615", "0", "2026-01-01T00:00:00Z"),
        ("1000", "0", "1970-01-01T00:00:00.000001Z"),
    ],
)
def test_event_time(spark, event, observed, shown):
    now = F.timestamp_micros(F.lit(1767225600000000))
    row = spark.createDataFrame([(event, observed)], "e string, o string")
    assert row.select(rfc3339(resolve_time(F.col("e"), F.col("o"), now))).first()[0] == shown


def test_time_defaults_to_now(spark):
    row = spark.createDataFrame([("0", "0")], "e string, o string")
    assert row.select(resolve_time(F.col("e"), F.col("o")) > "2020-01-01").first()[0]


def test_clock_changes_do_not_shift_times(spark):
    """The session is in a zone with summer time; both sides of a change must come out as UTC."""
    hours = [1710054000 + 1800 * i for i in range(8)] + [1730610000 + 1800 * i for i in range(8)]
    rows = spark.createDataFrame([(h * 1000000,) for h in hours], "us long")
    shown = [r[0] for r in rows.select(rfc3339(F.timestamp_micros("us"))).collect()]
    import datetime

    utc = datetime.timezone.utc
    assert shown == [datetime.datetime.fromtimestamp(h, utc).strftime("%Y-%m-%dT%H:%M:%SZ") for h in hours]


@pytest.mark.parametrize(
    "body, text",
    [('"a\\nb"', "a\nb"), ("null", ""), (None, ""), ("12", "12"), ('{"b":1}', '{"b":1}'), ('[1,"x"]', '[1,"x"]'), ('"null"', "null"), ('""', "")],
)
def test_body_text(spark, body, text):
    row = spark.createDataFrame([(body,)], "j string").select(F.parse_json("j").alias("b"))
    assert row.select(body_text(F.col("b"))).first()[0] == text

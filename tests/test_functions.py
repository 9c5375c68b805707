from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborlight.functions import identity, levels, strict_json, text, times

UTC = dt.timezone.utc


def one(spark, column, **values):
    """Evaluate a column over a one-row frame of string columns."""
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or (None,)], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2023-12-01T10:30:45.123456789Z", "2023-12-01 10:30:45.123456"),
        ("2023-12-01T10:30:45Z", "2023-12-01 10:30:45"),
        ("2023-12-01T10:30:45.5+02:00", "2023-12-01 08:30:45.5"),
        ("2023-12-01T10:30:45,25Z", "2023-12-01 10:30:45.25"),
        ("2023-12-01", None),
        ("2023-12-01 10:30:45Z", None),
        ("2023-12-01T10:30:45", None),
        ("2023-12-01T10:30:45z", None),
        ("2023-02-30T10:30:45Z", None),
        ("2023-12-01T10:60:45Z", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_rfc3339(spark, value, expected):
    assert one(spark, times.parse_rfc3339(F.col("v")).cast("string"), v=value) == expected


def test_zero_time_is_missing_in_objects(spark):
    zero = "0001-01-01T00:00:00Z"
    assert one(spark, times.parse_object_time(F.col("v")).cast("string"), v=zero) is None


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2023-12-01T10:30:45.120000Z", "2023-12-01T10:30:45.12Z"),
        ("2023-12-01T10:30:45Z", "2023-12-01T10:30:45Z"),
        ("2023-12-01T00:00:00+01:00", "2023-11-30T23:00:00Z"),
    ],
)
def test_time_text_cuts_zeros(spark, value, expected):
    assert one(spark, times.rfc3339_text(times.parse_rfc3339(F.col("v"))), v=value) == expected


def test_durations():
    assert times.parse_duration("1h30m") == dt.timedelta(minutes=90)
    assert times.parse_duration("0s") == dt.timedelta()
    assert times.parse_duration("1.5h") == dt.timedelta(minutes=90)
    assert times.parse_duration("500ms") == dt.timedelta(milliseconds=500)
    assert times.parse_duration("1m.5s2us") == dt.timedelta(seconds=60.5, microseconds=2)
    assert times.parse_duration("-1h") == -dt.timedelta(hours=1) and not times.parse_duration("0")
    for bad in ("", "h", "1d", "invalid-time", "1h x", "1.h.", "--1h"):
        with pytest.raises(ValueError):
            times.parse_duration(bad)


def test_since_precedence():
    now = dt.datetime(2024, 1, 2, tzinfo=UTC)
    explicit = dt.datetime(2024, 1, 1)
    assert times.resolve_since(explicit, "1h", now) == explicit.replace(tzinfo=UTC)
    assert times.resolve_since(None, "1h", now, "2h") == now - dt.timedelta(hours=1)
    assert times.resolve_since(None, None, now, "2h") == now - dt.timedelta(hours=2)
    assert times.resolve_since(None, None, now) is None


@pytest.mark.parametrize(
    "message, expected",
    [
        ('{"level":"error"}', "ERROR"),
        ('  {"level":"error"}\t', "ERROR"),
        (' {"lvl":"warning"} ', "WARNING"),
        ('{"level":7,"severity":"warning"}', "WARNING"),
        ('{"level":null,"log_level":"x"}', "X"),
        ('{"loglevel":"notice"}', "NOTICE"),
        ('{"level":"","severity":"fatal"}', "FATAL"),  # empty stops, then the word
        ('{"level":"","severity":"mild"}', "INFO"),
        ('{"level":{"a":1},"lvl":["x"],"severity":true,"log_level":"dbg"}', "DBG"),
        ('{"Level":"error"}', "ERROR"),  # keys are case-sensitive; the word is found
        ('{"Level":"odd"}', "INFO"),
        ('{"level":"debug"} trailing', "DEBUG"),  # not JSON; the word is found
        ('{"level":"odd"} {"level":"odder"}', "INFO"),
        ('{"level":"odd"},{"level":"odder"}', "INFO"),
        ("{'level':'odd'}", "INFO"),
        ('{"level":"a","level":"b"}', "B"),
        ('level="debug" user=3', "DEBUG"),
        ("lvl = 'warning'", "WARNING"),
        ("x severity=odd level=error", "ODD"),
        ('level="" error', "ERROR"),
        ("log_level=trace Warning: x", "WARN"),
        ("Level=odd", "INFO"),
        ("mylevel=odd", "INFO"),
        ("élevel=odd", "ODD"),  # word boundaries are ASCII
        ("level=\u000bodd", "\u000bODD"),  # vertical tab is no space for the pattern
        ("a=b no level here", "INFO"),
        ("INFORMATION warned", "WARN"),
        ("this is an Error and Fatal", "FATAL"),
        ("debugging trace", "DEBUG"),
        ("trace only", "TRACE"),
        ("plain", "INFO"),
    ],
)
def test_level_cascade(spark, message, expected):
    df = spark.createDataFrame([(message,)], "m string")
    df = strict_json.evaluate_once(df, d=levels.level_docs(F.col("m")))
    assert df.select(levels.level_cascade(F.col("d"), F.col("m"))).first()[0] == expected


@pytest.mark.parametrize(
    "value, blank", [("", True), (" \t  　", True), (" x ", False), ("​", False)]
)
def test_blank(spark, value, blank):
    assert one(spark, text.is_blank(F.col("v")), v=value) is blank


def test_trim_space(spark):
    assert one(spark, text.trim_space(F.col("v")), v="　\t a b \u0085") == "a b"


def test_merge_key_keeps_empty_parts(spark):
    key = identity.event_merge_key(*[F.col(c) for c in "abcde"])
    import hashlib

    got = one(spark, key, a="ns", b=None, c="Pod", d="p", e="")
    assert got == hashlib.md5(b"ns::Pod:p:").hexdigest()


def test_audit_identity(spark):
    def columns():
        return [F.col(c) for c in ("id", "verb", "res", "ns", "name", "uri")]

    ts = times.parse_rfc3339(F.col("t"))
    row = dict(id="", verb="get", res="pods", ns=None, name="n", uri="/x")
    got = one(spark, identity.audit_identity(*columns(), ts), **row, t="2024-01-01T00:00:00.500Z")
    assert got == "get|pods||n|/x|2024-01-01T00:00:00.5Z"
    got = one(spark, identity.audit_identity(*columns(), ts), **row, t=None)
    assert got == "get|pods||n|/x|0001-01-01T00:00:00Z"
    got = one(spark, identity.audit_identity(*columns(), ts), **(row | {"id": "a"}), t=None)
    assert got == "a"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2024-01-01T00:00:00.123456789Z", "n|p|c|2024-01-01T00:00:00.123456789Z"),
        ("2024-01-01T00:00:00.120000000Z", "n|p|c|2024-01-01T00:00:00.12Z"),
        ("2024-01-01T00:00:00.000000000Z", "n|p|c|2024-01-01T00:00:00Z"),
        ("2024-01-01T02:00:00.1230+02:00", "n|p|c|2024-01-01T00:00:00.123Z"),
        (None, "n|p|c|0001-01-01T00:00:00Z"),
    ],
)
def test_pod_log_identity_keeps_nanoseconds(spark, raw, expected):
    key = identity.pod_log_identity(
        F.lit("n"), F.lit("p"), F.lit("c"), times.parse_rfc3339(F.col("r")), F.col("r")
    )
    assert one(spark, key, r=raw) == expected


def test_event_identity_fallback(spark):
    parts = [F.lit(x) for x in ("ns", "Normal", "Pulled", "Pod", "p")]
    ts = times.parse_rfc3339(F.lit("2024-01-01T00:00:00Z"))
    assert one(spark, identity.event_identity(F.col("k"), *parts, ts), k="abc") == "abc"
    got = one(spark, identity.event_identity(F.col("k"), *parts, ts), k="")
    assert got == "ns|Normal|Pulled|Pod|p|2024-01-01T00:00:00Z"

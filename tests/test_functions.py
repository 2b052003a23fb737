from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ticketmill.functions import numeric, text, tickets, timestamps


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2026-06-02", "2026-06-02 00:00:00"), ("2026-6-2 1:2:3", "2026-06-02 01:02:03"),
        ("2026-06", "2026-06-01 00:00:00"), ("2026", "2026-01-01 00:00:00"), ("12345", None),
        ("20260602101112", "2026-06-02 10:11:12"), ("20260602 101112", "2026-06-02 10:11:12"),
        ("2026/06/02 10:11", "2026-06-02 10:11:00"), ("13/02/2026", "2026-02-13 00:00:00"),
        ("June 2, 2026", "2026-06-02 00:00:00"), ("02-Jun-2026", "2026-06-02 00:00:00"), ("20260230", None),
        ("2026-06-02 25:00:00", None), ("", None), ("99999999", None), ("2026-06-02T10:00:00Z", "2026-06-02 10:00:00"),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_timestamp(spark, value, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, value, "string", lambda c: timestamps.parse_timestamp(c).cast("string")) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "value, expected",
    [
        ("06/02/2026 10:30 PM", "2026-06-02 22:30:00"), ("2026-06-02 10:30 PM", "2026-06-02 22:30:00"),
        ("2 Jun 2026 10:30 AM", "2026-06-02 10:30:00"), ("06/02/2026 10:30:00.123", "2026-06-02 10:30:00.123"),
        ("2026/06/02 10:30:00.5", "2026-06-02 10:30:00.5"), ("20260602T101112", "2026-06-02 10:11:12"),
        ("2026.06.02", "2026-06-02 00:00:00"), ("06/02/26", "2026-06-02 00:00:00"), ("06/02/99", "1999-06-02 00:00:00"),
        ("June 2026", "2026-06-01 00:00:00"), ("Tue, 02 Jun 2026 10:00:00", "2026-06-02 10:00:00"),
        ("Tuesday, June 2, 2026", "2026-06-02 00:00:00"), ("2nd June 2026 12:05 a.m.", "2026-06-02 00:05:00"),
        ("june 2 2026 12:05 pm", "2026-06-02 12:05:00"), ("2026-06-02 13:00 PM", None), ("June 31, 2026", None),
        ("2026-06-02 10:30 XM", None), ("12:30", None), ("June", None), ("31/31/2026", None), ("2026-06-02 24:00", None),
        ("2 Juno 2026", None), ("2026-06-02 10:61", None), ("\u00a02026-06-02T10:00:00+05:30 ", "2026-06-02 10:00:00"),
    ],
)
def test_the_grammar_of_written_times(spark, value, expected):
    assert one(spark, value, "string", lambda c: timestamps.parse_timestamp(c).cast("string")) == expected


def test_times_ignore_the_session_zone(spark):
    """02:30 does not exist in New York on that day; nothing here may move it."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql(
            "SELECT timestamp_ntz'2024-03-10 02:30:59.9' a, timestamp_ntz'2024-03-10 03:01:00' b, '03/10/2024 02:30' t"
        ).select(
            timestamps.hour_label(F.col("a")),
            timestamps.response_latency_hours(F.col("a"), F.col("b")),
            timestamps.duration_seconds(F.col("a"), F.col("b")),
            timestamps.parse_timestamp(F.col("t")).cast("string"),
            timestamps.from_event_time(timestamps.to_event_time(F.col("a"))).cast("string"),
            timestamps.execution_id(F.col("a")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (
        "2024-03-10 02:00", 0.5, 1801.0, "2024-03-10 02:30:00", "2024-03-10 02:30:59.9", "20240310_023059",
    )


def test_run_label():
    assert timestamps.execution_label(datetime(2026, 6, 2, 21, 11, 14)) == "20260602_211114"


def test_latency_cuts_seconds_toward_zero(spark):
    row = spark.sql(
        "SELECT timestamp_ntz'2026-06-01 10:00:59' a, timestamp_ntz'2026-06-01 10:01:01' b, CAST(NULL AS timestamp_ntz) n"
    ).select(
        timestamps.response_latency_hours(F.col("a"), F.col("b")),
        timestamps.response_latency_hours(F.col("b"), F.col("a")),
        timestamps.response_latency_hours(F.col("a"), F.col("n")),
    )
    assert tuple(row.first()) == (0.0, 0.0, None)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("0.5", 0.5), (" -1.0 ", -1.0), ("1e-1", 0.1), (".5", 0.5), ("5.", 5.0), ("+0.2", 0.2), ("0.5f", None),
        ("0.5d", None), ("nan", None), ("inf", None), ("", None), ("1_0", 10.0), ("1__0", None), ("0x1", None),
    ],
)
def test_to_double(spark, value, expected):
    assert one(spark, value, "string", numeric.to_double) == expected


def test_rounding_is_half_up(spark):
    assert one(spark, 0.25, "double", lambda c: numeric.round_half_up(c, 1)) == 0.3
    assert one(spark, -0.25, "double", lambda c: numeric.round_half_up(c, 1)) == -0.3
    assert one(spark, 1.005, "double", lambda c: numeric.round_half_up(c, 2)) == 1.01
    assert one(spark, 0, "int", lambda c: numeric.percentage(F.lit(1), c)) is None


@pytest.mark.parametrize("value, expected", [("x", 0.0), ("0.3", 0.3), (None, 0.0), ("NaN", 0.0)])
def test_number_or_zero(spark, value, expected):
    assert one(spark, value, "string", numeric.number_or_zero) == expected


@pytest.mark.parametrize(
    "score, expected",
    [(-1.0, "P1-URGENT"), (-0.6, "P1-URGENT"), (-0.5, "P2-HIGH"), (-0.1, "P2-HIGH"), (0.0, "P3-NORMAL"),
     (0.4, "P3-NORMAL"), (0.5, "P4-LOW"), (1.0, "P4-LOW")],
)
def test_severity(spark, score, expected):
    assert one(spark, score, "double", tickets.severity) == expected


def test_strip_is_unicode_and_missing_tokens(spark):
    assert one(spark, "　\x1c a \xa0", "string", text.strip) == "a"
    df = spark.createDataFrame([("NA", 1), ("na", 2), ("", 3), ("None", 4), (" NA", 5)], "t string, n int")
    assert [r.t for r in text.null_missing(df).orderBy("n").collect()] == [None, "na", None, None, " NA"]


def test_digest_keeps_columns_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("~", "abc")], "a string, b string")
    assert df.select(text.digest(F.col("a"), F.col("b")).alias("d")).distinct().count() == 5

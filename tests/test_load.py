"""Fact, gold and reports on a handful of rows that can be checked by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ticketmill.functions.tickets import unanswered_risk
from ticketmill.operators import load, reports
from ticketmill.schemas import FACT_COLUMNS

# Rows in the older layout: the score is called `sentiment`, there is an id and no e-mail address.
LEGACY = [
    ("INC-10001", "2026-06-01 21:54:25", "AU-SYDNEY", "2026-06-02 01:43:19", 0.9, "Feedback"),
    ("INC-10002", "2026-06-02 01:19:53", "CA-TORONTO", "2026-06-02 09:22:30", 0.9, "Feedback"),
    ("INC-10003", "2026-06-02 12:43:00", "JP-TOKYO", "2026-06-03 12:27:41", -0.5, "Technical"),
    ("INC-10004", "2026-06-02 01:20:49", "JP-TOKYO", "2026-06-02 01:40:00", -0.6, "Technical"),
    ("INC-10005", "2026-06-02 15:22:29", "AU-SYDNEY", "2026-06-03 03:42:47", -0.7, "Technical"),
    ("INC-10006", "2026-06-02 17:27:59", "UK-LONDON", None, 0.9, "Feedback"),
    ("INC-10007", "2026-06-01 23:12:24", "JP-TOKYO", "2026-06-02 13:04:19", 0.0, "How-To Question"),
    ("INC-10008", "2026-06-02 18:19:07", "UK-LONDON", "2026-06-02 20:56:03", -0.5, "Technical"),
    ("INC-10009", "2026-06-02 19:31:09", "AU-SYDNEY", None, -0.4, "Account"),
    ("INC-10010", "2026-06-02 07:20:52", "AU-SYDNEY", "2026-06-02 15:03:32", 0.0, "How-To Question"),
]
EXPECTED = {
    "INC-10001": (3.8, "P4-LOW"), "INC-10002": (8.03, "P4-LOW"), "INC-10003": (23.73, "P2-HIGH"),
    "INC-10004": (0.32, "P1-URGENT"), "INC-10005": (12.33, "P1-URGENT"), "INC-10006": (None, "P4-LOW"),
    "INC-10007": (13.85, "P3-NORMAL"), "INC-10008": (2.6, "P2-HIGH"), "INC-10009": (None, "P2-HIGH"),
    "INC-10010": (7.7, "P3-NORMAL"),
}


@pytest.fixture(scope="module")
def silver(spark):
    columns = "ticket_id string, created_at string, region string, first_response_at string, sentiment double, category string"
    df = load.from_legacy(spark.createDataFrame(LEGACY, columns))
    return df.withColumns(
        {
            "created_at": F.col("created_at").cast("timestamp_ntz"),
            "first_response_at": F.col("first_response_at").cast("timestamp_ntz"),
            "email_address": F.col("ticket_id"),
            "customer_text": F.lit("text"),
            "analysis_source": F.lit("gemini"),
        }
    )


@pytest.fixture(scope="module")
def gold(silver, regions, categories):
    return load.gold_tickets(load.prepare_fact(silver, regions, categories), regions, categories)


def test_latency_and_severity(gold):
    assert {r.email_address: (r.response_latency_hrs, r.severity) for r in gold.collect()} == EXPECTED


def test_severity_report(gold):
    assert [tuple(r) for r in reports.severity_report(gold).collect()] == [
        ("P1-URGENT", 2, 2, 0, 6.33),
        ("P2-HIGH", 3, 2, 1, 13.17),
        ("P3-NORMAL", 2, 2, 0, 10.78),
        ("P4-LOW", 3, 2, 1, 5.92),
    ]


def test_other_reports(gold):
    assert [tuple(r) for r in reports.category_sentiment(gold).collect()] == [
        ("Technical", -0.58, 4),
        ("Account", -0.4, 1),
        ("How-To Question", 0.0, 2),
        ("Feedback", 0.9, 3),
    ]
    risk = unanswered_risk(F.col("severity"), F.col("first_response_at"))
    assert [tuple(r) for r in reports.region_escalation(gold, risk).collect()] == [
        ("AU-SYDNEY", 0, 1, 4),
        ("CA-TORONTO", 0, 0, 1),
        ("JP-TOKYO", 0, 0, 3),
        ("UK-LONDON", 0, 0, 2),
    ]
    assert {tuple(r) for r in reports.open_vs_responded(gold).collect()} == {("Open", 2), ("Responded", 8)}
    trend = [tuple(r) for r in reports.hourly_trend(gold).collect()]
    assert trend[0] == ("2026-06-01 21:00", 1) and ("2026-06-02 01:00", 2) in trend and len(trend) == 9


def test_sla(spark, gold):
    targets = spark.createDataFrame([("P1-URGENT", 4.0), ("P2-HIGH", 2.6)], "severity string, target_hours double")
    assert [tuple(r) for r in reports.sla_performance(gold, targets).collect()] == [
        ("P1-URGENT", 2, 1, 1, 0, 50.0),
        ("P2-HIGH", 3, 1, 1, 1, 50.0),
        ("P3-NORMAL", 2, 0, 0, 0, None),
        ("P4-LOW", 3, 0, 0, 1, None),
    ]


def test_fact_columns_and_unknown_names(silver, regions, categories):
    odd = silver.limit(1).withColumns({"region": F.lit("X"), "category": F.lit("Y"), "channel": F.lit("mail")})
    fact = load.prepare_fact(odd, regions, categories, "2026-06-10 00:00:00")
    assert fact.columns == [*FACT_COLUMNS, "ingestion_date"]
    row = fact.first()
    assert (row.region_id, row.category_id, str(row.ingestion_date)) == (None, None, "2026-06-10 00:00:00")
    assert load.gold_tickets(fact, regions, categories).first().region is None


def test_keys(silver, regions, categories):
    fact = load.prepare_fact(silver, regions, categories).repartition(3)
    keyed = load.with_generated_key(fact, "ticket_id", start_after=41).collect()
    assert len({r.ticket_id for r in keyed}) == 10 and min(r.ticket_id for r in keyed) == 42
    key = load.content_key(F.col("email_address"), F.col("created_at"))
    first, second = ({r[0] for r in fact.repartition(n).select(key).collect()} for n in (1, 4))
    assert first == second and len(first) == 10 and all(len(k) == 64 for k in first)


def test_defaults(spark):
    df = spark.createDataFrame([("N",), (None,)], "is_active string")
    rows = load.with_defaults(df, {"is_active": F.lit("Y"), "created_at": F.lit("now")}).collect()
    assert [tuple(r) for r in rows] == [("N", "now"), ("Y", "now")]

"""Every registered query against its SQL on DuckDB, and known totals."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_file
from verification.compare import connect, duckdb_rows, spark_rows
from verification.queries import ORACLES, QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries()) and set(ORACLES) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == duckdb_rows(duck, ORACLES[name])


def test_entry_has_rows(spark):
    assert [r.severity for r in entry_file.entry(spark).collect()] == ["P1-URGENT", "P2-HIGH", "P3-NORMAL", "P4-LOW"]


@pytest.mark.parametrize(
    "sf, read, failed, duplicate, valid",
    [("0.001", 1000, 203, 166, 631), ("0.01", 10000, 1990, 1725, 6285), ("0.1", 100000, 19887, 17131, 62982)],
)
def test_validation_totals(spark, sf, read, failed, duplicate, valid):
    row = QUERIES["validation_summary"](spark, f"/root/testdata/sf{sf}").first()
    assert (row.rows_read, row.rows_failed, row.rows_duplicate, row.rows_valid) == (read, failed, duplicate, valid)
    assert row.rows_quarantined == failed + duplicate


def test_reports_at_medium_scale(spark):
    severity = QUERIES["severity_report"](spark, MEDIUM).collect()
    assert [tuple(r) for r in severity] == [
        ("P1-URGENT", 785, 607, 178, 11.73),
        ("P2-HIGH", 923, 721, 202, 11.67),
        ("P3-NORMAL", 3662, 2892, 770, 12.11),
        ("P4-LOW", 915, 722, 193, 11.97),
    ]
    category = QUERIES["category_sentiment"](spark, MEDIUM).collect()
    assert [tuple(r) for r in category] == [
        ("Technical", -0.12, 715),
        ("Account", -0.05, 1256),
        ("Billing", -0.03, 1206),
        ("How-To Question", 0.01, 722),
        ("Feedback", 0.13, 677),
        ("General", 0.23, 1709),
    ]
    sources = {r.analysis_source: r.total_records for r in QUERIES["source_counts"](spark, MEDIUM).collect()}
    assert sources == {"gemini": 5719, "textblob": 566}
    trend = QUERIES["hourly_trend"](spark, MEDIUM).collect()
    assert len(trend) == 717 and max(r.ticket_count for r in trend) == 23
    assert [r.created_date for r in trend] == sorted(r.created_date for r in trend)


def test_run_log_at_medium_scale(spark):
    health = {r.stage_id: r for r in QUERIES["run_health"](spark, MEDIUM).collect()}
    assert [(health[s].failed_runs, health[s].started_runs, health[s].success_runs) for s in (1, 2, 3, 4)] == [
        (145, 21, 1834), (140, 21, 1839), (133, 21, 1846), (264, 41, 3695),
    ]
    latest = QUERIES["latest_attempt"](spark, MEDIUM).groupBy("run_status").count().collect()
    assert {r.run_status: r["count"] for r in latest} == {"FAILED": 540, "STARTED": 84, "SUCCESS": 7376}

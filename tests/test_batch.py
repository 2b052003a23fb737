"""Stored runs: bronze to gold, reruns, empty runs, failures, and the log they leave."""

from __future__ import annotations

import json

import pytest
from conftest import AS_OF, ticket
from pyspark.sql import functions as F

from ticketmill.fixed_values import FACT_LENGTHS
from ticketmill.operators import reports, runlog
from ticketmill.plans import batch
from ticketmill.schemas import FACT
from ticketmill.sources import layers, reference_data

LEXICON = {"down": -0.8, "thanks": 0.9}


def rows():
    return [
        ticket(email_address="a@b.c", customer_text="it is down"),
        ticket(email_address="a@b.c", customer_text="it is down", created_at="2026-06-02 08:00:00"),
        ticket(email_address="b@b.c", customer_text="thanks a lot", first_response_at="2026-06-01 11:30:00"),
        ticket(region="XX-NOWHERE"),
    ]


def run(spark, bronze, root, name, raw=None, **options):
    raw = bronze(rows() if raw is None else raw).drop("_row_id")
    batch.run_all(spark, raw, root, name, LEXICON, as_of=AS_OF, **options)


def test_run_and_rerun(spark, bronze, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, bronze, root, "20260602_211114")
    first = sorted(map(tuple, batch.read_gold(spark, root).drop("ticket_id").collect()), key=str)
    assert [(r[0], str(r[1])) for r in first] == [("a@b.c", "2026-06-02 08:00:00"), ("b@b.c", "2026-06-01 10:00:00")]
    run(spark, bronze, root, "20260602_211114")
    assert sorted(map(tuple, batch.read_gold(spark, root).drop("ticket_id").collect()), key=str) == first
    assert [tuple(r) for r in reports.severity_report(batch.read_gold(spark, root)).collect()] == [
        ("P1-URGENT", 1, 0, 1, None),
        ("P4-LOW", 1, 1, 0, 1.5),
    ]
    reasons = {r.failure_reason for r in batch.read_quarantine(spark, root).collect()}
    assert reasons == {"Duplicate email and text", "Unrecognized region: XX-NOWHERE"}

    run(spark, bronze, root, "20260603_211114")
    fact = layers.read_layer(spark, f"{root}/support_tickets")
    assert {f.name: f.dataType for f in fact.schema} == {f.name: f.dataType for f in FACT}
    assert fact.count() == 4 == fact.select("ticket_id").distinct().count()

    runs = batch.read_runs(spark, root)
    assert runs.count() == 12
    latest = runlog.latest_attempts(runs).where("execution_id = '20260602_211114'").orderBy("stage_id").collect()
    assert [(r.stage_id, r.run_status) for r in latest] == [(s, "SUCCESS") for s in (1, 2, 3, 4)]
    landed, validated, enriched, loaded = (json.loads(r.metrics) for r in latest)
    assert landed == {"rows_generated": 4, "output_file": "20260602_211114"}
    assert validated == {
        "rows_read": 4, "rows_valid": 2, "rows_quarantined": 2, "validation_pass_rate": 50.0,
        "valid_output_file": "20260602_211114/valid", "quarantine_output_file": "20260602_211114/quarantined",
    }
    assert enriched == {
        "rows_read": 2, "rows_enriched": 2, "gemini_enrichments": 0, "textblob_enrichments": 2,
        "gemini_percentage": 0.0, "output_file": "20260602_211114",
    }
    assert (loaded["rows_loaded"], loaded["target_table"]) == (2, "support_tickets")
    usage = runlog.ai_usage_over_runs(runs, stage_id=3).collect()
    assert sum(r.rows_enriched for r in usage) == 6
    lineage = runlog.run_lineage(runs, reference_data.stage_names()).orderBy("execution_id").first()
    assert (lineage.attempts, lineage.generate_raw_data, lineage.load_to_lakehouse) == (8, "SUCCESS", "SUCCESS")


def test_a_run_without_valid_rows_succeeds(spark, bronze, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, bronze, root, "r1", raw=[ticket(region=None)])
    assert batch.read_gold(spark, root).count() == 0
    assert [r.run_status for r in batch.read_runs(spark, root).collect()] == ["SUCCESS"] * 4


def test_model_replies_are_stored_once(spark, bronze, tmp_path):
    root, calls = str(tmp_path / "lake"), spark.sparkContext.accumulator(0)

    def score(prompt):
        calls.add(1)
        return "0.6|Billing"

    run(spark, bronze, root, "r1", score=score, delay_seconds=0)
    assert calls.value == 2
    assert {(r.category, r.sentiment_score) for r in batch.read_gold(spark, root).collect()} == {("Billing", 0.6)}


def test_a_lexicon_table_gives_the_same_silver_rows(spark, bronze, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, bronze, root, "r1")
    columns = ["email_address", "sentiment_score", "category", "analysis_source"]
    first = layers.read_layer(spark, f"{root}/silver", "r1").select(columns).collect()
    table = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    batch.enrich_run(spark, root, "r1", table)
    again = layers.read_layer(spark, f"{root}/silver", "r1")
    assert sorted(again.select(columns).collect()) == sorted(first) and "_local_score" not in again.columns


def test_failures_are_logged_and_raised(spark, bronze, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="Input dataset is empty."):
        run(spark, bronze, root, "r1", raw=[])
    with pytest.raises(ZeroDivisionError):
        batch.logged_stage(spark, root, "r1", "AI Enrichment", lambda: 1 / 0)
    failed = runlog.failed_runs(batch.read_runs(spark, root)).collect()
    assert [(r.stage_id, r.error_message) for r in failed] == [(3, "division by zero"), (2, "Input dataset is empty.")]


def test_a_load_that_breaks_a_constraint_writes_nothing(spark, bronze, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="constraint violated: customer_text is longer than 1000"):
        run(spark, bronze, root, "r1", raw=[ticket(), ticket(customer_text="ä" * 501)])
    assert not (tmp_path / "lake" / "support_tickets").exists()
    assert [r.stage_id for r in runlog.failed_runs(batch.read_runs(spark, root)).collect()] == [4]


def test_rows_over_the_limits_are_quarantined_and_all_others_load(spark, bronze, tmp_path):
    long = [ticket(customer_text="ä" * 501), ticket(email_address="a" * 100 + "@b.c"), ticket(customer_text="x" * 1000)]
    run(spark, bronze, str(tmp_path / "lake"), "r1", raw=[*rows(), *long], limits=FACT_LENGTHS)
    gold = batch.read_gold(spark, str(tmp_path / "lake")).collect()
    assert sorted(len(r.customer_text) for r in gold) == [10, 12, 1000]
    quarantine = batch.read_quarantine(spark, str(tmp_path / "lake"))
    reasons = [r.failure_reason for r in quarantine.where("failure_reason LIKE '%longer%'").collect()]
    assert sorted(reasons) == ["customer_text is longer than 1000", "email_address is longer than 100"]
    assert quarantine.count() == 4

    run(spark, bronze, str(tmp_path / "wide"), "r1", raw=[*rows(), *long], limits={"customer_text": 2000})
    assert sorted(len(r.customer_text.encode()) for r in batch.read_gold(spark, str(tmp_path / "wide")).collect())[-2:] == [1000, 1002]
    batch.load_run(spark, str(tmp_path / "wide"), "r1", AS_OF, rules=[])


def test_run_state_of_repeated_and_running_events(spark):
    runs = spark.createDataFrame([(1, "e", 1), (2, "e", 1), (3, "e", 2)], "run_id long, execution_id string, stage_id long")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2026-06-01 10:00:00.9", "2026-06-01 10:00:03.1"))
    events = runlog.start_events(runs, start)
    events = events.unionByName(runlog.failure_events(runs.where("run_id = 1"), end, F.lit("x" * 1500)))
    events = events.unionByName(runlog.success_events(runs.where("run_id = 2"), end, F.lit('{"a": 1}')))
    states = {r.run_id: r for r in runlog.run_state(events.unionByName(events)).collect()}
    assert len(states[1].error_message) > 1000 and states[1].run_status == "FAILED"
    assert (states[2].run_status, states[2].duration_seconds, states[2].metrics) == ("SUCCESS", 3.0, '{"a": 1}')
    assert (states[3].run_status, states[3].run_end_time, states[3].duration_seconds) == ("STARTED", None, None)
    latest = {r.stage_id: r.run_id for r in runlog.latest_attempts(runlog.run_state(events)).collect()}
    assert latest == {1: 2, 2: 3}


def test_a_skipped_run_has_an_end_alone(spark):
    runs = spark.createDataFrame([(1, "e", 1)], "run_id long, execution_id string, stage_id long")
    at = F.lit("2026-06-01 10:00:00").cast("timestamp_ntz")
    row = runlog.run_state(runlog.skipped_events(runs, at)).first()
    assert (row.run_status, row.run_start_time, row.duration_seconds) == ("SKIPPED", None, None)


def test_percentiles_are_exact(spark):
    import numpy as np

    seconds = [float(v) for v in (1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 1000)]
    runs = spark.createDataFrame([(1, s) for s in seconds] + [(1, None)], "stage_id long, duration_seconds double")
    row = runlog.stage_performance(runs).first()
    assert row.ended_runs == len(seconds) and row.max_seconds == 1000.0
    assert row.median_seconds == np.percentile(seconds, 50) and row.p95_seconds == round(np.percentile(seconds, 95), 2)

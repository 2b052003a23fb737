"""Keep-latest against brute force, with hot keys, ties and nulls."""

from __future__ import annotations

import random

import pytest
from conftest import AS_OF, physical_plan, ticket
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketmill.operators import dedup, validation
from ticketmill.schemas import ROW_ID

KEYS = ["email_address", "customer_text"]
COLUMNS = f"{ROW_ID} long, email_address string, customer_text string, at long, ok boolean"


def newest(rows, eligible_only):
    best = {}
    for row_id, email, text, at, ok in rows:
        if ok or not eligible_only:
            key = (email, text)
            if key not in best or (at, -row_id) > best[key]:
                best[key] = (at, -row_id)
    return {-row_id for _, row_id in best.values()}


def check(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    kept = dedup.keep_latest(df, KEYS, newest="at", tie=[ROW_ID])
    assert {r[ROW_ID] for r in kept.collect()} == newest(rows, eligible_only=False)
    marked = dedup.mark_superseded(
        df, [], KEYS, newest="at", row_id=ROW_ID, eligible=F.col("ok"), flag="old"
    ).collect()
    assert len(marked) == len(rows)
    good = newest(rows, eligible_only=True)
    assert {r[ROW_ID] for r in marked if r.old} == {r[0] for r in rows if r[4] and r[0] not in good}


def test_a_hot_key_next_to_many_small_ones(spark):
    rng = random.Random(7)
    rows = [
        (i, "hot@x.y", "same", rng.randrange(50), rng.random() < 0.9)
        if i % 3 == 0
        else (i, f"u{rng.randrange(400)}@x.y", rng.choice(["a", "b", None]), rng.randrange(50), rng.random() < 0.9)
        for i in range(6000)
    ]
    check(spark, rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", ""]), st.integers(-2, 2), st.booleans()),
        min_size=1,
        max_size=30,
    )
)
def test_any_small_table(spark, rows):
    check(spark, [(i, *row) for i, row in enumerate(rows)])


@pytest.fixture(scope="module")
def mixed():
    rows = [ticket(email_address=f"u{i % 4}@x.y", customer_text=f"t{i % 3}", created_at=f"2026-06-0{i % 5 + 1}") for i in range(40)]
    return rows + [ticket(region="XX-NOWHERE")] * 3 + [ticket()] * 2


def test_summary_counts_agree_with_rows(bronze, regions, mixed):
    checked = validation.check_tickets(bronze(mixed), regions, AS_OF)
    valid, quarantine = validation.valid_tickets(checked), validation.quarantined_tickets(checked)
    summary = validation.validation_summary(checked).first()
    assert valid.count() == summary.rows_valid and quarantine.count() == summary.rows_quarantined
    assert summary.rows_read == len(mixed) == summary.rows_valid + summary.rows_quarantined
    assert valid.groupBy(*KEYS).count().where("count > 1").isEmpty()
    assert quarantine.where("failure_reason = '' OR failure_reason IS NULL").isEmpty()
    judged = validation.summarize_judged(validation.judge_tickets(checked)).first()
    assert (judged.rows_valid, judged.validation_pass_rate) == (summary.rows_valid, summary.validation_pass_rate)
    reasons = {r.failure_reason: r.row_count for r in validation.failure_reason_counts(checked).collect()}
    expected = quarantine.groupBy("failure_reason").count().collect()
    assert reasons == {r.failure_reason: r["count"] for r in expected}
    assert {r[ROW_ID] for r in valid.collect()} == {
        r[ROW_ID] for r in validation.judge_tickets(checked).where(validation.passed()).collect()
    }


def test_copies_in_different_runs_are_no_duplicates(bronze, regions):
    df = bronze([ticket()] * 4).withColumn("execution_id", (F.col(ROW_ID) % 2).cast("string"))
    checked = validation.check_tickets(df, regions, AS_OF)
    assert sorted(r[ROW_ID] for r in validation.valid_tickets(checked).collect()) == [0, 1]
    assert sorted(r[ROW_ID] for r in validation.quarantined_tickets(checked).collect()) == [2, 3]
    by_run = {r.execution_id: r.rows_valid for r in validation.validation_summary(checked, ["execution_id"]).collect()}
    assert by_run == {"0": 1, "1": 1}


def test_quarantine_keeps_raw_text(bronze, regions):
    df = bronze([ticket(created_at="06/01/2026"), ticket(created_at="Jun 2 2026")])
    old = validation.quarantined_tickets(validation.check_tickets(df, regions, AS_OF)).collect()
    assert [(r.created_at, r.failure_reason) for r in old] == [("06/01/2026", "Duplicate email and text")]


def test_drop_known_is_null_safe(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, "b", None)], "id int, k string, l string")
    known = spark.createDataFrame([("a", None)] * 3, "k string, l string")
    assert sorted(r.id for r in dedup.drop_known(df, known, ["k", "l"]).collect()) == [2, 3]


def test_no_rows(bronze, regions):
    checked = validation.check_tickets(bronze([]), regions, AS_OF)
    summary = validation.validation_summary(checked).first()
    assert (summary.rows_read, summary.rows_valid, summary.validation_pass_rate) == (0, 0, None)
    assert validation.valid_tickets(checked).isEmpty() and validation.quarantined_tickets(checked).isEmpty()


def test_hot_keys_are_cut_before_the_shuffle(bronze, regions):
    checked = validation.check_tickets(bronze([ticket()]), regions, AS_OF)
    plan = physical_plan(validation.valid_tickets(checked))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(email_address") < plan.index("Partial")
    marked = physical_plan(validation.judge_tickets(checked))
    assert "partial_max_by" in marked and "Window" not in marked

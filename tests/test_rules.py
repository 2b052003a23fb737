"""One raw row in, the exact reason out."""

from __future__ import annotations

import pytest
from conftest import AS_OF, ticket
from pyspark.sql import functions as F

from ticketmill.operators import validation
from ticketmill.operators.constraints import (
    duplicate_keys,
    in_set_rules,
    max_length_rules,
    not_null_rules,
    orphans,
    pipeline_rules,
    require_rules,
    run_rules,
    violations,
)
from ticketmill.operators.rules import apply_rules
from ticketmill.sources import reference_data

CASES = [
    (ticket(), ""),
    (ticket(email_address=None), "email_address is NULL or blank"),
    (ticket(email_address=" \t　"), "email_address is NULL or blank"),
    (ticket(email_address="no-at-sign"), "Invalid email format: no-at-sign"),
    (ticket(email_address="missingatsign.com"), "Invalid email format: missingatsign.com"),
    (ticket(email_address="@example.org"), "Invalid email format: @example.org"),
    (ticket(email_address="test@"), "Invalid email format: test@"),
    (ticket(email_address="12345"), "Invalid email format: 12345"),
    (ticket(email_address="a@b@c.de"), "Invalid email format: a@b@c.de"),
    (ticket(email_address="a b@c.de"), "Invalid email format: a b@c.de"),
    (ticket(email_address="a\xa0b@c.de"), "Invalid email format: a\xa0b@c.de"),
    (ticket(email_address="  a@b.c "), ""),
    (ticket(email_address="a@b."), "Invalid email format: a@b."),
    (ticket(email_address="a@.b"), "Invalid email format: a@.b"),
    (ticket(email_address="x@y..z"), ""),
    (ticket(created_at=None), "created_at is NULL or blank"),
    (ticket(created_at="  "), "created_at is NULL or blank"),
    (ticket(created_at="not-a-date"), "created_at is not a valid datetime: not-a-date"),
    (ticket(created_at="12345"), "created_at is not a valid datetime: 12345"),
    (ticket(created_at="2026-02-30"), "created_at is not a valid datetime: 2026-02-30"),
    (ticket(created_at="9999-12-31"), "created_at is not a valid datetime: 9999-12-31"),
    (ticket(created_at="1500-01-01"), "created_at is not a valid datetime: 1500-01-01"),
    (ticket(created_at="2262-04-11 23:47:16.854775"), "created_at is in future date"),
    (ticket(first_response_at="12/31/9999"), "first_response_at is not a valid datetime: 12/31/9999"),
    (ticket(created_at=AS_OF), ""),
    (ticket(created_at="2026-06-10 00:00:01"), "created_at is in future date"),
    (ticket(created_at="2026-06-01 10:00:00.123456"), ""),
    (ticket(created_at="20260602"), ""),
    (ticket(created_at="06/02/2026"), ""),
    (ticket(created_at="Jun 2 2026"), ""),
    (ticket(created_at="2026-06-02T10:00:00+05:00"), ""),
    (ticket(customer_text=None), "customer_text is NULL or blank"),
    (ticket(customer_text="   "), "customer_text is NULL or blank"),
    (ticket(customer_text="\x1c\x1f"), "customer_text is NULL or blank"),
    (ticket(region=None), "region is NULL or blank"),
    (ticket(region=" "), "region is NULL or blank"),
    (ticket(region="U-CENTRAL"), "Unrecognized region: U-CENTRAL"),
    (ticket(region="XX-NOWHERE"), "Unrecognized region: XX-NOWHERE"),
    (ticket(region="NEW-JERSEY"), "Unrecognized region: NEW-JERSEY"),
    (ticket(region="JAPAN"), "Unrecognized region: JAPAN"),
    (ticket(region="THAILAND"), "Unrecognized region: THAILAND"),
    (ticket(region=" JP-TOKYO"), "Unrecognized region:  JP-TOKYO"),
    (ticket(region="jp-tokyo"), "Unrecognized region: jp-tokyo"),
    (ticket(first_response_at="later"), "first_response_at is not a valid datetime: later"),
    (ticket(first_response_at="   "), "first_response_at is not a valid datetime:    "),
    (ticket(first_response_at="2026-06-01 10:00:00"), ""),
    (ticket(first_response_at="2026-06-01 09:59:59"), "first_response_at must be after created_at"),
    (ticket(created_at=None, first_response_at="2020-01-01"), "created_at is NULL or blank"),
    (
        ticket(created_at="nope", first_response_at="2020-01-01"),
        "created_at is not a valid datetime: nope",
    ),
    (
        ticket(email_address="x; y", created_at="2027-01-01", customer_text="", region=None, first_response_at="2026-01-01"),
        "Invalid email format: x; y; created_at is in future date; customer_text is NULL or blank; "
        "region is NULL or blank; first_response_at must be after created_at",
    ),
]


@pytest.fixture(scope="module")
def reasons(spark, regions):
    columns = "n long, email_address string, created_at string, customer_text string, region string, first_response_at string"
    df = spark.createDataFrame([(i, *row) for i, (row, _) in enumerate(CASES)], columns)
    checked = validation.check_tickets(df, regions, AS_OF)
    return {r.n: r for r in checked.select("n", "failure_reason", "failed_rules").collect()}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_reason(reasons, number):
    assert reasons[number].failure_reason == CASES[number][1]


def test_rule_names_do_not_depend_on_values(reasons):
    assert reasons[len(CASES) - 1].failed_rules == [
        "email_format", "created_future", "text_blank", "region_blank", "response_early",
    ]
    assert reasons[0].failed_rules == []


def test_as_of_may_be_a_column(bronze, regions):
    checked = validation.check_tickets(bronze([ticket(created_at="2200-01-01")]), regions, F.localtimestamp())
    assert checked.first().failure_reason == "created_at is in future date"


def test_missing_columns_and_no_rows(spark, bronze, regions):
    with pytest.raises(ValueError, match=r"Missing required columns: \['region', 'first_response_at'\]"):
        validation.check_tickets(bronze([ticket()]).drop("region", "first_response_at"), regions, AS_OF)
    with pytest.raises(ValueError, match="Input dataset is empty."):
        validation.require_rows(bronze([]))


def test_extra_columns_pass_through(bronze, regions):
    df = bronze([ticket()]).withColumn("channel", F.lit("mail"))
    assert validation.valid_tickets(validation.check_tickets(df, regions, AS_OF)).first().channel == "mail"


def test_constraint_rules(spark):
    df = spark.createDataFrame([(1, "Y", "ab"), (2, None, "äb"), (3, "X", None)], "id int, flag string, name string")
    rules = not_null_rules(["name"]) + in_set_rules({"flag": ["Y", "N"]}) + max_length_rules({"name": 2})
    judged = {r.id: r.failure_reason for r in apply_rules(df, rules).collect()}
    assert judged[1] == ""
    assert judged[3] == "name is NULL; flag not allowed: X"
    assert judged[2] == "name is longer than 2"


def test_length_in_bytes_or_characters(spark):
    df = spark.createDataFrame([("äb",)], "name string")
    assert apply_rules(df, max_length_rules({"name": 2})).first().failure_reason == "name is longer than 2"
    assert apply_rules(df, max_length_rules({"name": 2}, in_bytes=False)).first().failure_reason == ""


def test_duplicate_keys_and_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 1), (3, None), (4, None), (5, 9)], "id int, fk int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert [tuple(r) for r in duplicate_keys(child, ["fk"]).collect()] == [(1, 2)]
    assert [r.id for r in orphans(child, "fk", parent, "id").collect()] == [5]


def test_rules_of_the_stored_tables(spark):
    runs = spark.createDataFrame(
        [("e", 1, "SUCCESS", None), ("e", None, "DONE", "x" * 1001), ("e" * 21, 2, None, "x")],
        "execution_id string, stage_id long, run_status string, error_message string",
    )
    assert {r.failure_reason for r in violations(runs, run_rules()).collect()} == {
        "stage_id is NULL; run_status not allowed: DONE; error_message is longer than 1000",
        "execution_id is longer than 20",
    }
    assert violations(reference_data.pipelines(spark), pipeline_rules()).isEmpty()
    with pytest.raises(ValueError, match="stage_id is NULL"):
        require_rules(runs.where("stage_id IS NULL"), run_rules())

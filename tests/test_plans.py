"""Plan shapes that have to hold at any size: what is shuffled, read and evaluated."""

from __future__ import annotations

import re

import pytest
from conftest import AS_OF, physical_plan, ticket
from pyspark.sql import functions as F

from ticketmill import schemas
from ticketmill.operators import load, reports, validation
from ticketmill.operators.constraints import orphans
from ticketmill.operators.dedup import drop_known
from ticketmill.operators.enrichment import enrich_tickets, lexicon_polarity, score_by_lexicon
from ticketmill.operators.lookup import flag_members, lookup_value
from ticketmill.operators.scoring import score_tickets
from ticketmill.plans.session import MIB, cluster_options
from ticketmill.schemas import ROW_ID
from ticketmill.sources import layers


@pytest.fixture
def stored(spark, bronze, tmp_path):
    """Bronze rows in a Parquet folder, as a run leaves them."""
    path = str(tmp_path / "bronze")
    bronze([ticket(), ticket(region=None)]).write.parquet(path)
    return spark.read.parquet(path)


def exchanges(df) -> list[str]:
    return re.findall(r"(?<!Broadcast)Exchange (\w+\([^)]*\))", physical_plan(df))


def gold(stored, regions, categories):
    checked = validation.check_tickets(stored, regions, AS_OF)
    valid = validation.valid_tickets(checked).withColumn("model_reply", F.lit(None).cast("string"))
    silver = enrich_tickets(valid, categories, lexicon_polarity(F.col("customer_text"), {"reset": 0.1}))
    return load.gold_tickets(load.prepare_fact(silver, regions, categories, AS_OF), regions, categories)


def test_one_shuffle_from_raw_to_gold(stored, regions, categories):
    shuffles = exchanges(gold(stored, regions, categories))
    assert len(shuffles) == 1 and "email_address" in shuffles[0]


def test_checks_shuffle_nothing(stored, regions):
    checked = validation.check_tickets(stored, regions, AS_OF)
    assert not exchanges(checked) and "CartesianProduct" not in physical_plan(checked)


def test_the_narrow_side_of_judging_carries_no_text(stored, regions):
    plan = physical_plan(validation.judge_tickets(validation.check_tickets(stored, regions, AS_OF)))
    partial = plan[plan.rindex("partial_max_by") :]
    keys = partial[: partial.index("\n")]
    assert "customer_text" not in keys and "email_address" not in keys


def test_reports_read_their_columns_only(spark, stored, regions, categories, tmp_path):
    path = str(tmp_path / "fact")
    fact = load.with_generated_key(
        gold(stored, regions, categories).select(*schemas.FACT_COLUMNS, "ingestion_date"), "ticket_id"
    )
    layers.write_run(fact, path, "r1")
    table = load.gold_tickets(layers.read_layer(spark, path, "r1", schemas.FACT), regions, categories)
    plan = physical_plan(reports.severity_report(table))
    assert re.search(
        r"ReadSchema: struct<created_at:timestamp_ntz,first_response_at:timestamp_ntz,sentiment_score:double>", plan
    )
    assert table.inputFiles() and all("/execution_id=r1/" in file for file in table.inputFiles())
    assert "Join" not in plan
    assert reports.category_sentiment(table).first().volume == 1


def test_a_filter_reaches_the_files(spark, stored, regions, categories, tmp_path):
    path = str(tmp_path / "fact")
    layers.write_run(gold(stored, regions, categories).select(*schemas.FACT_COLUMNS), path, "r1")
    late = layers.read_layer(spark, path).where(F.col("created_at") >= F.lit("2026-06-01").cast("timestamp_ntz"))
    assert "GreaterThanOrEqual(created_at" in physical_plan(late)


def test_a_model_is_called_once_per_row(spark, categories):
    calls = spark.sparkContext.accumulator(0)

    def score(prompt):
        calls.add(1)
        return "0.5|Billing"

    valid = spark.range(20).select(F.col("id").alias(ROW_ID), F.lit("some text").alias("customer_text"))
    scored = score_tickets(valid, score, delay_seconds=0)
    silver = enrich_tickets(scored, categories, F.lit(0.0)).where("sentiment_score > 0 AND category = 'Billing'")
    assert silver.count() == 20 and calls.value == 20


def test_rule_conditions_are_evaluated_once(stored, regions):
    """A filter on the reason moves below the projection; the e-mail test must not multiply there."""
    plan = physical_plan(validation.valid_tickets(validation.check_tickets(stored, regions, AS_OF)))
    assert plan.count("RLIKE(email_address") == 1


@pytest.fixture
def splitting(spark):
    """Thresholds at which a few thousand rows count as a skewed partition, and nothing is broadcast."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("operator", ["flag_members", "lookup_value", "orphans", "drop_known", "score_by_lexicon"])
def test_a_hot_key_is_split_when_the_reference_is_shuffled(spark, splitting, tmp_path, operator):
    """A third of the rows share one key; the reference repeats keys and is too large to broadcast."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id")))
    spark.range(60_000).repartition(4).select(
        "id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    ).write.parquet(str(tmp_path / "rows"))
    spark.range(20_000).select(
        F.concat(F.lit("k"), F.col("id") % 9000).alias("name"), F.col("id").alias("value")
    ).write.parquet(str(tmp_path / "reference"))
    rows, reference = (spark.read.parquet(str(tmp_path / n)) for n in ("rows", "reference"))
    result = {
        "flag_members": lambda: flag_members(rows, "k", reference, "name", "hit").where("NOT hit"),
        "lookup_value": lambda: lookup_value(rows, "k", reference, "name", "value").where("value IS NULL"),
        "orphans": lambda: orphans(rows, "k", reference, "name"),
        "drop_known": lambda: drop_known(rows, reference.withColumnRenamed("name", "k"), ["k"]),
        "score_by_lexicon": lambda: score_by_lexicon(
            rows, "k", "id", reference.select(F.col("name").alias("word"), F.lit(0.5).alias("polarity")).union(
                spark.sql("SELECT 'hot', 1.0")
            )
        ).where("sentiment_score <> 0.5"),
    }[operator]()
    counted = result.agg(F.count(F.lit(1)).alias("n"), F.max("payload"))
    assert [row.n for row in counted.collect()] == [54_000]
    assert "skew=true" in physical_plan(counted)


def test_cluster_options():
    options = cluster_options(100 * 1024**4, cores=8000)
    assert int(options["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * MIB)
    assert cluster_options(10, cores=16)["spark.sql.shuffle.partitions"] == "32"

"""Business reports over the gold table.

All of them aggregate to a handful of rows with map-side partial aggregates, so a hot category or
region costs nothing extra, and only the small result is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions.numeric import average, percentage
from ticketmill.functions.tickets import severity_rank, ticket_status
from ticketmill.functions.timestamps import hour_label
from ticketmill.operators.lookup import lookup_value

HOURS = "decimal(18,2)"


def _count() -> Column:
    return F.count(F.lit(1))


def severity_report(gold: DataFrame) -> DataFrame:
    answered = F.count("first_response_at")
    return (
        gold.groupBy("severity")
        .agg(
            _count().alias("ticket_count"),
            answered.alias("responded_tickets"),
            (_count() - answered).alias("unanswered_tickets"),
            average(F.col("response_latency_hrs"), 2, HOURS).alias("avg_latency_hrs"),
        )
        .orderBy(severity_rank(F.col("severity")), "severity")
    )


def category_sentiment(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("category")
        .agg(average(F.col("sentiment_score"), 2).alias("avg_sentiment_score"), _count().alias("volume"))
        .orderBy("avg_sentiment_score", "category")
    )


def region_escalation(gold: DataFrame, risk: Column) -> DataFrame:
    """`risk` is an expression that gives CRITICAL, HIGH or anything else for a row."""
    return (
        gold.select("region", risk.alias("_risk"))
        .groupBy("region")
        .agg(
            F.count_if(F.col("_risk") == "CRITICAL").alias("critical_count"),
            F.count_if(F.col("_risk") == "HIGH").alias("high_risk_count"),
            _count().alias("total_tickets"),
        )
        .orderBy(F.desc("critical_count"), "region")
    )


def open_vs_responded(gold: DataFrame) -> DataFrame:
    status = ticket_status(F.col("first_response_at")).alias("ticket_status")
    return gold.groupBy(status).agg(_count().alias("total_tickets"))


def source_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("analysis_source").agg(_count().alias("total_records"))


def hourly_trend(gold: DataFrame) -> DataFrame:
    hour = hour_label(F.col("created_at")).alias("created_date")
    return gold.groupBy(hour).agg(_count().alias("ticket_count")).orderBy("created_date")


def sla_performance(gold: DataFrame, targets: DataFrame, by: Sequence[str] = ("severity",)) -> DataFrame:
    """Tickets answered within, answered after, and not answered, against `targets(severity, target_hours)`.

    The small targets table meets the rows, then one aggregate; tickets without a target count in
    the total and among the unanswered only.
    """
    limit = F.col("_limit").cast(HOURS)
    hours = F.col("response_latency_hrs").cast(HOURS)
    waiting = F.col("first_response_at").isNull()
    met = F.count_if(~waiting & (hours <= limit))
    return (
        lookup_value(gold, "severity", targets, "severity", "target_hours", "_limit")
        .groupBy(*by)
        .agg(
            _count().alias("total_tickets"),
            met.alias("met_target"),
            F.count_if(~waiting & (hours > limit)).alias("missed_target"),
            F.count_if(waiting).alias("unanswered"),
            percentage(met, F.count_if(~waiting & limit.isNotNull())).alias("met_percentage"),
        )
        .orderBy(*by)
    )

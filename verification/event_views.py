"""Tickets, model replies and a run log derived from the `events` table.

Every value follows from the columns of an event by a fixed rule, so the same table can be written
in SQL and both sides can be compared at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.functions.timestamps import second_label
from ticketmill.operators.runlog import failure_events, start_events, success_events
from ticketmill.schemas import ROW_ID

AS_OF = "2024-02-01 00:00:00"
TEXTS = [
    "You charged my card two times, please refund one of them.",
    "Excellent answer, and quick too: I appreciate that.",
    "Three wrong tries and my account is disabled.",
    "How do I change the password of a colleague?",
    "The site is down again and keeps crashing.",
]
REGIONS = ["CA-TORONTO", "AU-SYDNEY", "UK-LONDON", "SG-CENTRAL", "JP-TOKYO"]
REPLY_CATEGORIES = ["Technical", "Billing", "Account", "Feedback", "How-To Question"]
LEXICON = {
    "charged": -0.4, "refund": -0.2, "excellent": 1.0, "appreciate": 0.6, "disabled": -0.5, "down": -0.6,
    "crashing": -0.8,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def tickets(events: DataFrame) -> DataFrame:
    i, ts = F.col("event_id"), F.col("ts")
    whole = F.floor("value").cast("bigint")
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), 300 + (i * 7919) % 86100)
    return events.select(
        i.alias(ROW_ID),
        F.when(i % 50 == 1, None)
        .when(i % 50 == 2, "no-at-sign")
        .when(i % 50 == 3, "@example.org")
        .when(i % 50 == 4, "   ")
        .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@mail.example.org")))
        .alias("email_address"),
        F.when(i % 60 == 5, None)
        .when(i % 60 == 6, "not-a-date")
        .when(i % 60 == 7, second_label(ts + F.expr("interval 400 days")))
        .otherwise(second_label(ts))
        .alias("created_at"),
        F.when(i % 70 == 8, None)
        .when(i % 70 == 9, "   ")
        .otherwise(
            F.concat(_choose(TEXTS, (F.col("user_id") + whole) % 5), F.lit(" Ref "), whole.cast("string"))
        )
        .alias("customer_text"),
        F.when(i % 80 == 10, None).when(i % 80 == 11, "XX-NOWHERE").otherwise(_choose(REGIONS, i % 5)).alias("region"),
        F.when(i % 5 == 0, None)
        .when(i % 90 == 12, second_label(ts - F.expr("interval 3 hours")))
        .when(i % 90 == 13, "later")
        .otherwise(second_label(ts + delay))
        .alias("first_response_at"),
    )


def replies(df: DataFrame) -> DataFrame:
    """Add the reply column of a ticket table."""
    i = F.col(ROW_ID)
    score = ((i % 21 - 10).cast("decimal(4,0)") / F.lit(10)).cast("decimal(3,1)").cast("string")
    return df.withColumn(
        "model_reply",
        F.when(i % 11 == 0, None)
        .when(i % 11 == 1, "garbage")
        .when(i % 11 == 2, "2.5|Account")
        .when(i % 11 == 3, "0.4| Billing")
        .when(i % 11 == 4, "nan|Billing")
        .when(i % 11 == 5, "0.3|Unknown")
        .otherwise(F.concat(score, F.lit("|"), _choose(REPLY_CATEGORIES, i % 5))),
    )


def run_events(events: DataFrame) -> DataFrame:
    """The run log of the events: one run per event, five runs per execution, stage 4 tried twice."""
    i, ts = F.col("event_id"), F.col("ts")
    running = i % 97 == 0
    failed = ~running & (F.col("event_type") == "error") & (i % 3 == 0)
    end = ts + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.floor(F.col("value") * 1000) / 1000).cast("decimal(18,6)")
    )

    def number(value: Column) -> Column:
        return value.cast("string")

    valid, model = 100 + i % 50 - i % 7, 100 + i % 50 - i % 9
    metrics = (
        F.when(i % 5 == 0, F.concat(F.lit('{"rows_generated": '), number(100 + i % 50), F.lit("}")))
        .when(
            i % 5 == 1,
            F.concat(
                F.lit('{"rows_read": '), number(100 + i % 50), F.lit(', "rows_valid": '), number(valid),
                F.lit(', "rows_quarantined": '), number(i % 7), F.lit("}"),
            ),
        )
        .when(
            i % 5 == 2,
            F.concat(
                F.lit('{"rows_read": '), number(100 + i % 50), F.lit(', "rows_enriched": '), number(100 + i % 50),
                F.lit(', "gemini_enrichments": '), number(model), F.lit(', "textblob_enrichments": '),
                number(i % 9), F.lit("}"),
            ),
        )
        .otherwise(F.concat(F.lit('{"rows_loaded": '), number(100 + i % 50), F.lit("}")))
    )
    runs = events.select(
        i.alias("run_id"),
        F.floor(i / 5).cast("string").alias("execution_id"),
        F.when(i % 5 == 4, 4).otherwise(i % 5 + 1).cast("bigint").alias("stage_id"),
        ts.alias("_start"),
        end.alias("_end"),
        running.alias("_running"),
        failed.alias("_failed"),
        metrics.alias("_metrics"),
        F.concat(F.lit("stage failed at "), F.col("props")).alias("_error"),
    )
    succeeded = runs.where(~F.col("_running") & ~F.col("_failed"))
    return (
        start_events(runs, F.col("_start"))
        .unionByName(success_events(succeeded, F.col("_end"), F.col("_metrics")))
        .unionByName(failure_events(runs.where(F.col("_failed")), F.col("_end"), F.col("_error")))
    )

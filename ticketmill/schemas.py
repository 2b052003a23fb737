"""Column lists and Spark types of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

from ticketmill.fixed_values import REQUIRED_COLUMNS

ROW_ID = "_row_id"
EXECUTION_ID = "execution_id"
TICKET_ID = "ticket_id"


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


# Raw files carry text only; types are given after the checks have passed.
BRONZE = T.StructType([T.StructField(name, T.StringType(), True) for name in REQUIRED_COLUMNS])

FACT_COLUMNS = [
    "email_address",
    "created_at",
    "customer_text",
    "first_response_at",
    "sentiment_score",
    "analysis_source",
    "region_id",
    "category_id",
]
FACT_REQUIRED = ["email_address", "created_at", "customer_text", "sentiment_score", "analysis_source"]

# The stored fact; the run id is its partition column.
FACT = _struct(
    ("email_address", T.StringType(), False),
    ("created_at", T.TimestampNTZType(), False),
    ("customer_text", T.StringType(), False),
    ("first_response_at", T.TimestampNTZType(), True),
    ("sentiment_score", T.DoubleType(), False),
    ("analysis_source", T.StringType(), False),
    ("region_id", T.IntegerType(), True),
    ("category_id", T.IntegerType(), True),
    ("ingestion_date", T.TimestampNTZType(), True),
    (TICKET_ID, T.LongType(), False),
    (EXECUTION_ID, T.StringType(), False),
)

DIM_REGIONS = _struct(("region_id", T.IntegerType(), False), ("region_name", T.StringType(), False))
DIM_CATEGORIES = _struct(("category_id", T.IntegerType(), False), ("category_name", T.StringType(), False))
PIPELINES = _struct(
    ("pipeline_id", T.LongType(), False),
    ("pipeline_code", T.StringType(), False),
    ("is_active", T.StringType(), True),
    ("pipeline_name", T.StringType(), False),
    ("pipeline_descr", T.StringType(), True),
)
STAGES = _struct(
    ("stage_id", T.LongType(), False),
    ("pipeline_id", T.LongType(), False),
    ("stage_order", T.IntegerType(), False),
    ("stage_name", T.StringType(), False),
    ("stage_descr", T.StringType(), True),
)
CONFIGURATION = _struct(
    ("config_id", T.LongType(), False),
    ("config_key", T.StringType(), False),
    ("config_value", T.StringType(), False),
)

# One row per thing that happened to a run; run_state folds them into one row per run.
RUN_EVENTS = _struct(
    ("run_id", T.LongType(), False),
    ("execution_id", T.StringType(), False),
    ("stage_id", T.LongType(), False),
    ("run_status", T.StringType(), True),
    ("event_time", T.TimestampNTZType(), True),
    ("metrics", T.StringType(), True),
    ("error_message", T.StringType(), True),
)

VALIDATION_METRICS = _struct(
    ("rows_read", T.LongType(), True),
    ("rows_valid", T.LongType(), True),
    ("rows_quarantined", T.LongType(), True),
    ("validation_pass_rate", T.DoubleType(), True),
    ("valid_output_file", T.StringType(), True),
    ("quarantine_output_file", T.StringType(), True),
)
ENRICHMENT_METRICS = _struct(
    ("rows_read", T.LongType(), True),
    ("rows_enriched", T.LongType(), True),
    ("output_file", T.StringType(), True),
    ("gemini_enrichments", T.LongType(), True),
    ("textblob_enrichments", T.LongType(), True),
    ("gemini_percentage", T.DoubleType(), True),
)

"""Fact rows and the gold table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions.text import digest
from ticketmill.functions.tickets import severity
from ticketmill.functions.timestamps import ntz, response_latency_hours
from ticketmill.operators.lookup import lookup_value
from ticketmill.schemas import EXECUTION_ID, FACT_COLUMNS


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill a column that is absent or null with its default."""
    return df.withColumns(
        {name: F.coalesce(name, value) if name in df.columns else value for name, value in defaults.items()}
    )


def with_generated_key(df: DataFrame, column: str, start_after: int = 0) -> DataFrame:
    """A unique long per row, larger than `start_after`; with gaps, as an identity column has."""
    return df.withColumn(column, F.monotonically_increasing_id() + F.lit(start_after + 1))


def with_dense_key(stored: DataFrame, column: str, start_after: int = 0) -> DataFrame:
    """Number the rows of a table of Parquet files `start_after` + 1, + 2 and so on, without a gap.

    A row's number is how many rows the files before its own have, plus its place in its file: one row
    for each file is counted and summed, and no row is moved. Reading the files in other splits
    gives the same numbers. `stored` must be the table as it is read, with its `_metadata`.
    """
    placed = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_row") + F.lit(start_after + 1)
    return placed.join(starts, "_file").withColumn(column, number).drop("_file", "_row", "_before")


def content_key(*columns: Column) -> Column:
    """A key that follows from the content, so a rerun gives the same row the same key.

    256 bits as hex text: 64-bit hashes meet by chance within some billions of rows.
    """
    return F.lower(F.hex(digest(*[c.cast("string") for c in columns])))


def prepare_fact(
    silver: DataFrame, regions: DataFrame, categories: DataFrame, ingested_at: datetime | str | Column | None = None,
    key: str | None = None,
) -> DataFrame:
    """Fact columns in their fixed order, names replaced by keys; unknown names give null keys.

    The run id stays where there is one (it partitions the stored table), and `ingestion_date` is
    the given load time or the one a row already has. `key` names a column of generated keys to keep.
    """
    keyed = lookup_value(silver, "region", regions, "region_name", "region_id")
    keyed = lookup_value(keyed, "category", categories, "category_name", "category_id")
    keyed = keyed.withColumns(
        {
            "created_at": F.col("created_at").cast("timestamp_ntz"),
            "first_response_at": F.col("first_response_at").try_cast("timestamp_ntz"),
        }
    )
    if ingested_at is not None:
        keyed = with_defaults(keyed, {"ingestion_date": ntz(ingested_at)})
    extra = [name for name in ("ingestion_date", key, EXECUTION_ID) if name in keyed.columns]
    return keyed.select(*FACT_COLUMNS, *extra)


def with_measures(fact: DataFrame) -> DataFrame:
    """Add the derived columns `response_latency_hrs` and `severity`."""
    return fact.withColumns(
        {
            "response_latency_hrs": response_latency_hours(F.col("created_at"), F.col("first_response_at")),
            "severity": severity(F.col("sentiment_score")),
        }
    )


def gold_tickets(fact: DataFrame, regions: DataFrame, categories: DataFrame) -> DataFrame:
    """Fact with derived columns and the names behind its keys, ready for the reports."""
    named = lookup_value(with_measures(fact), "region_id", regions, "region_id", "region_name", "region")
    return lookup_value(named, "category_id", categories, "category_id", "category_name", "category")


def from_legacy(df: DataFrame) -> DataFrame:
    """Older silver files call the score `sentiment`."""
    return df.withColumnRenamed("sentiment", "sentiment_score")

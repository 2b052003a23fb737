"""Tickets arriving as files: ingest, hourly trend, keep-latest over all batches.

Each trigger handles what is new and stops, so a daily job is one run of the same code. A batch is
one run of the pipeline: it replaces its own partitions, so a batch that is repeated after a crash
leaves the same tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.group import GroupedData
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ticketmill.fixed_values import DUPLICATE_KEY, NA_TOKENS
from ticketmill.functions.text import null_missing
from ticketmill.functions.timestamps import hour_label, ntz, parse_timestamp, to_event_time
from ticketmill.operators.dedup import drop_known, keep_latest
from ticketmill.plans.batch import judge, land, read_validated
from ticketmill.schemas import BRONZE, EXECUTION_ID, ROW_ID
from ticketmill.sources import files, layers, versions

EVENT_TIME = "_event_time"
#: New rows of a bucket are merged with older ones when they are half as many.
MERGE_AT = 0.5


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BRONZE,
    format: str = "csv",
    files_per_batch: int | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """New raw files below a folder; CSV columns must come in the order of the schema.

    `multi_line` allows line breaks inside quoted text but makes a file one task.
    """
    reader = spark.readStream.schema(schema).format(format)
    if format == "csv":
        reader = reader.options(header=True, quote='"', escape='"', multiLine=multi_line, enforceSchema=False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return null_missing(reader.load(path), na_tokens)


def run_of_batch(spark: SparkSession, batch: int, checkpoint: str) -> str:
    """Run id of a batch: its number, and the id its stream got when its checkpoint began.

    A stream that begins anew, also in the same folder, has another id, so streams into one root never
    replace each other's batches, while a batch that is repeated after a crash replaces itself.
    """
    stream = json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]
    return f"b{stream.replace('-', '')[:16]}_{batch:010d}"


def ingest(
    stream: DataFrame,
    regions: DataFrame,
    as_of: datetime | str | Column,
    root: str,
    checkpoint: str | None = None,
    limits: Mapping[str, int] | None = None,
    keep_current: bool = False,
) -> StreamingQuery:
    """Check every new batch and store it below `root`. `as_of` may be F.localtimestamp().

    Rows over `limits` (bytes by column) are quarantined, as in `batch.validate_run`. With `keep_current`, a
    table of the newest copy of each ticket is kept as well, see `read_current`.
    """

    checkpoint = checkpoint or f"{root}/_checkpoint"

    def handle(batch: DataFrame, number: int) -> None:
        run = run_of_batch(batch.sparkSession, number, checkpoint)
        judge(land(batch, root, run), regions, as_of, root, run, limits)
        if keep_current:
            _load_current(read_validated(batch.sparkSession, root, run), root)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_tickets(validated: DataFrame, tie: Sequence[str] = (EXECUTION_ID, ROW_ID)) -> DataFrame:
    """The newest copy of each ticket over all stored batches, chosen from the whole history.

    `read_current` reads the same from a table that `ingest` keeps, without going over the history.
    """
    return keep_latest(validated, DUPLICATE_KEY, newest="created_at", tie=tie)


def _load_current(validated: DataFrame, root: str) -> None:
    """Load a batch into the table of newest copies. Of equally new ones the smallest in all columns stays,
    so the order in which files arrive has no say; what a batch rewrites follows the batch."""
    tie = [ROW_ID, *[c for c in validated.columns if c not in (*DUPLICATE_KEY, "created_at", ROW_ID, EXECUTION_ID)]]
    versions.upsert(
        validated.drop(EXECUTION_ID), f"{root}/current", DUPLICATE_KEY, "created_at", tie, merge_at=MERGE_AT
    )


def read_current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest copy of each ticket over all batches, or over those up to an older version.

    Buckets of the key that a batch has just added to are merged in reading, all others are read as they are.
    """
    return versions.read(spark, f"{root}/current", version)


def first_copies(stream: DataFrame, delay: str, key: Sequence[str] = tuple(DUPLICATE_KEY)) -> DataFrame:
    """Keep-first within the watermark, for consumers that cannot wait; state is bounded by the delay.

    Rows later than `delay` are dropped by the watermark; `run_first_copies` drops none. Every copy
    travels to the task of its key. Give `typed_stream` an `as_of`, or one row from the future makes all
    others late.
    """
    return stream.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark(list(key))


def run_first_copies(stream: DataFrame, root: str, key: Sequence[str] = tuple(DUPLICATE_KEY)) -> DataFrame:
    """Store the first copy of every key over all batches, however late it comes, and return them.

    A batch is reduced to one row for each key and stores those that no other batch holds.
    """
    path = f"{root}/first"

    def handle(batch: DataFrame, number: int) -> None:
        run, offered = run_of_batch(batch.sparkSession, number, f"{root}/_checkpoint"), batch.dropDuplicates(list(key)).drop(EVENT_TIME)
        if layers.exists(batch.sparkSession, path):
            stored = layers.read_layer(batch.sparkSession, path).where(F.col(EXECUTION_ID) != run)
            offered = drop_known(offered, stored, key)
        layers.write_run(offered, path, run)

    _run(stream.writeStream, handle, root)
    return layers.read_layer(stream.sparkSession, path).drop(EXECUTION_ID)


def typed_stream(stream: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """Rows with a readable creation time, typed, and its event time for the operators below.

    With `as_of`, rows created later are left out, which keeps a watermark from running ahead.
    """
    typed = stream.withColumn("created_at", parse_timestamp(F.col("created_at")))
    typed = typed.where(F.col("created_at").isNotNull())
    if as_of is not None:
        typed = typed.where(F.col("created_at") <= ntz(as_of))
    return typed.withColumn(EVENT_TIME, to_event_time(F.col("created_at")))


def hourly_trend(stream: DataFrame, delay: str) -> DataFrame:
    """Tickets per hour of creation, as an event-time window, for consumers that need it live.

    State is bounded by the delay, and rows that come later than it are not counted any more; use
    `run_hourly_trend` where every row has to count.
    """
    hour = F.window(EVENT_TIME, "1 hour")
    return stream.withWatermark(EVENT_TIME, delay).groupBy(hour).agg(F.count(F.lit(1)).alias("ticket_count"))


def run_hourly_trend(stream: DataFrame, root: str) -> DataFrame:
    """Count all new rows and return the trend. Each batch stores its own counts per hour and the
    trend is their sum: there is no state, and no row is too late."""

    def handle(batch: DataFrame, number: int) -> None:
        hour = hour_label(F.col("created_at")).alias("created_date")
        counts = batch.groupBy(hour).agg(F.count(F.lit(1)).alias("ticket_count"))
        layers.write_run(counts, f"{root}/trend", run_of_batch(batch.sparkSession, number, f"{root}/_checkpoint"))

    _run(stream.writeStream, handle, root)
    return _stored_trend(stream.sparkSession, root).agg(F.sum("ticket_count").alias("ticket_count"))


def _run(writer: DataStreamWriter, handle: Callable[[DataFrame, int], None], root: str) -> None:
    writer.foreachBatch(handle).option("checkpointLocation", f"{root}/_checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()


def _stored_trend(spark: SparkSession, root: str) -> GroupedData:
    schema = "created_date string, ticket_count bigint, execution_id string"
    return spark.read.schema(schema).parquet(f"{root}/trend").groupBy("created_date")

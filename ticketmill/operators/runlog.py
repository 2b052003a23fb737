"""The run log: an append-only table of events, folded into runs, and the reports over it.

Events are rows, never updates, so any number of writers may append and a replayed event changes
nothing that `run_state` returns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.fixed_values import FAILED, RUN_STATUSES, SKIPPED, STARTED, SUCCESS
from ticketmill.functions.numeric import percentage, round_half_up
from ticketmill.functions.timestamps import day_label, duration_seconds
from ticketmill.operators.dedup import keep_latest
from ticketmill.schemas import ENRICHMENT_METRICS, RUN_EVENTS, VALIDATION_METRICS


def _events(
    runs: DataFrame, status: str, time: Column, metrics: Column | None = None, error: Column | None = None
) -> DataFrame:
    values = {
        "run_status": F.lit(status),
        "event_time": time,
        "metrics": metrics if metrics is not None else F.lit(None),
        "error_message": error if error is not None else F.lit(None),
    }
    return runs.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RUN_EVENTS.fields]
    )


def start_events(runs: DataFrame, time: Column) -> DataFrame:
    """Runs (`run_id`, `execution_id`, `stage_id`) that begin at `time`."""
    return _events(runs, STARTED, time)


def success_events(runs: DataFrame, time: Column, metrics: Column) -> DataFrame:
    """Runs that end well; `metrics` is JSON text, see `metrics_json`."""
    return _events(runs, SUCCESS, time, metrics=metrics)


def failure_events(runs: DataFrame, time: Column, error: Column) -> DataFrame:
    """Runs that end badly, with the whole error text; whether it is too long is for the check rules to say."""
    return _events(runs, FAILED, time, error=error)


def skipped_events(runs: DataFrame, time: Column) -> DataFrame:
    """Runs that were not carried out; they need no start."""
    return _events(runs, SKIPPED, time)


def metrics_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def metric(name: str, kind: str) -> Column:
    """A metric out of the stored JSON of a run; null where the run has none, or one of another kind.

    The JSON is read as a variant, so a metric that is new needs no schema.
    """
    return F.try_variant_get(F.try_parse_json("metrics"), f"$.{name}", kind)


def metrics_over_runs(runs: DataFrame, kinds: Mapping[str, str], by: Sequence[str] = ("stage_id",)) -> DataFrame:
    """Sums of any numeric metrics of successful runs, with how many runs have them."""
    read = runs.where(F.col("run_status") == SUCCESS).select(*by, *[metric(n, kind).alias(n) for n, kind in kinds.items()])
    return read.groupBy(*by).agg(
        *[F.count(name).alias(f"{name}_runs") for name in kinds], *[F.sum(name).alias(name) for name in kinds]
    )


def run_state(events: DataFrame) -> DataFrame:
    """One row per run: its start, and the last thing that happened to it."""
    ended = F.col("run_status") != STARTED
    last = F.struct(ended.alias("ended"), "event_time", "run_status", "metrics", "error_message")
    folded = events.groupBy("run_id", "execution_id", "stage_id").agg(
        F.min(F.when(~ended, F.col("event_time"))).alias("run_start_time"), F.max(last).alias("_last")
    )
    end = F.when(F.col("_last.ended"), F.col("_last.event_time"))
    return folded.select(
        "run_id",
        "execution_id",
        "stage_id",
        F.col("_last.run_status").alias("run_status"),
        "run_start_time",
        end.alias("run_end_time"),
        duration_seconds(F.col("run_start_time"), end).alias("duration_seconds"),
        F.col("_last.metrics").alias("metrics"),
        F.col("_last.error_message").alias("error_message"),
    )


def latest_attempts(runs: DataFrame) -> DataFrame:
    """The last run of each stage of an execution; a retry leaves several."""
    return keep_latest(runs, ["execution_id", "stage_id"], newest="run_id", tie=[])


def with_stage_names(runs: DataFrame, stages: DataFrame, pipelines: DataFrame) -> DataFrame:
    named = stages.join(pipelines.select("pipeline_id", "pipeline_code"), "pipeline_id")
    return runs.join(named.select("stage_id", "stage_order", "stage_name", "pipeline_code"), "stage_id")


def run_health(runs: DataFrame, by: Sequence[str] = ("stage_id",)) -> DataFrame:
    """Runs per status and the share of successes in percent."""
    total = F.count(F.lit(1))
    statuses = [F.count_if(F.col("run_status") == s).alias(f"{s.lower()}_runs") for s in RUN_STATUSES]
    return (
        runs.groupBy(*by)
        .agg(
            total.alias("total_runs"),
            *statuses,
            percentage(F.count_if(F.col("run_status") == SUCCESS), total).alias("success_rate"),
        )
        .orderBy(*by)
    )


def stage_performance(runs: DataFrame, by: Sequence[str] = ("stage_id",)) -> DataFrame:
    """Count, total, mean, extremes, median and 95th percentile of the duration of ended runs.

    Durations are whole seconds, so counting equal ones first leaves few rows per stage, and the
    exact percentiles need no more memory than there are different durations.
    """
    seconds, n = F.col("duration_seconds"), F.col("_runs")
    equal = (
        runs.where(seconds.isNotNull())
        .groupBy(*by, "duration_seconds")
        .agg(F.count(F.lit(1)).alias("_runs"))
    )
    return (
        equal.groupBy(*by)
        .agg(
            F.sum(n).alias("ended_runs"),
            F.sum(seconds * n).alias("total_seconds"),
            round_half_up(F.sum(seconds * n) / F.sum(n), 2).alias("avg_seconds"),
            F.min(seconds).alias("min_seconds"),
            F.max(seconds).alias("max_seconds"),
            F.percentile(seconds, F.lit(0.5), n).alias("median_seconds"),
            round_half_up(F.percentile(seconds, F.lit(0.95), n), 2).alias("p95_seconds"),
        )
        .orderBy(*by)
    )


def _with_metrics(runs: DataFrame, stage_id: int, schema: T.StructType) -> DataFrame:
    return runs.where((F.col("stage_id") == stage_id) & (F.col("run_status") == SUCCESS)).select(
        day_label(F.col("run_start_time")).alias("run_date"),
        F.from_json("metrics", schema).alias("_metrics"),
    )


def _sum_metric(name: str) -> Column:
    return F.coalesce(F.sum(f"_metrics.{name}"), F.lit(0))


def validation_over_runs(runs: DataFrame, stage_id: int) -> DataFrame:
    """Validation results per day, out of the stored metrics of successful runs."""
    return (
        _with_metrics(runs, stage_id, VALIDATION_METRICS)
        .groupBy("run_date")
        .agg(
            F.count(F.lit(1)).alias("run_count"),
            *[_sum_metric(name).alias(name) for name in ("rows_read", "rows_valid", "rows_quarantined")],
            percentage(_sum_metric("rows_valid"), _sum_metric("rows_read")).alias("validation_pass_rate"),
        )
        .orderBy("run_date")
    )


def ai_usage_over_runs(runs: DataFrame, stage_id: int) -> DataFrame:
    """Model and fallback enrichments per day, out of the stored metrics of successful runs."""
    names = ("rows_read", "rows_enriched", "gemini_enrichments", "textblob_enrichments")
    return (
        _with_metrics(runs, stage_id, ENRICHMENT_METRICS)
        .groupBy("run_date")
        .agg(
            F.count(F.lit(1)).alias("run_count"),
            *[_sum_metric(name).alias(name) for name in names],
            percentage(_sum_metric("gemini_enrichments"), _sum_metric("rows_read")).alias("gemini_percentage"),
        )
        .orderBy("run_date")
    )


def runtime_trend(runs: DataFrame, by: Sequence[str] = ("stage_id",)) -> DataFrame:
    """Seconds spent per day and stage."""
    day = day_label(F.col("run_start_time")).alias("run_date")
    return (
        runs.groupBy(day, *by)
        .agg(F.count(F.lit(1)).alias("run_count"), F.sum("duration_seconds").alias("total_seconds"))
        .orderBy("run_date", *by)
    )


def failed_runs(runs: DataFrame) -> DataFrame:
    """Failed runs, newest first."""
    return (
        runs.where(F.col("run_status") == FAILED)
        .select(
            "run_id", "execution_id", "stage_id", "run_start_time", "run_end_time", "duration_seconds",
            "error_message",
        )
        .orderBy(F.desc("run_start_time"), F.desc("run_id"))
    )


def run_lineage(runs: DataFrame, stage_names: dict[int, str]) -> DataFrame:
    """One row per execution with the latest status of each stage, as columns in stage order.

    The latest attempt is the largest (run id, status) pair, so one aggregate does both the choice
    and the pivot.
    """
    attempt = F.struct("run_id", "run_status")
    latest = {
        name.lower().replace(" ", "_"): F.max(F.when(F.col("stage_id") == stage_id, attempt))
        for stage_id, name in stage_names.items()
    }
    return runs.groupBy("execution_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        *[column["run_status"].alias(name) for name, column in latest.items()],
    )

"""One run from raw files to the fact table, every stage stored and logged.

Layout below `root`: bronze, judged (valid and quarantined rows), replies, silver, support_tickets,
run_log. Each stage reads what the stage before has stored and replaces its own run's partition, so
any stage may be repeated, by this run or by a later one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import schemas
from ticketmill.fixed_values import FACT_TABLE, REQUIRED_COLUMNS
from ticketmill.operators import load, runlog, validation
from ticketmill.functions.numeric import percentage
from ticketmill.operators.constraints import fact_rules, max_length_rules
from ticketmill.operators.enrichment import (
    Modifiers, enrich_tickets, enrichment_counts, lexicon_polarity, score_by_lexicon, with_model_share,
)
from ticketmill.operators.lookup import lookup_stage_ids
from ticketmill.operators.rules import FAILED_RULES, REASON, Rule, apply_rules
from ticketmill.operators.scoring import score_tickets, score_tickets_from_store
from ticketmill.schemas import EXECUTION_ID, ROW_ID, RUN_EVENTS, TICKET_ID
from ticketmill.sources import files, layers, reference_data

OUTCOME, VALID, QUARANTINED = "outcome", "valid", "quarantined"
PIPELINE = "AI_SUPPORT"
#: Bytes of a row group of landed rows.
LANDED_ROW_GROUP = 8 * 1024 * 1024


def land(bronze: DataFrame, root: str, run: str) -> DataFrame:
    """Store raw rows with an id that no later reading can change, and read them back.

    A few large files, as a stream brings them, land in as few tasks; small row groups let all cores judge them.
    """
    landed = bronze if ROW_ID in bronze.columns else layers.with_row_ids(bronze)
    layers.write_run(landed, f"{root}/bronze", run, row_group=LANDED_ROW_GROUP)
    return layers.read_layer(bronze.sparkSession, f"{root}/bronze", run, _with_run(landed.schema))


def _with_run(schema: T.StructType) -> T.StructType:
    kept = [f for f in schema.fields if f.name != EXECUTION_ID]
    return T.StructType([*kept, T.StructField(EXECUTION_ID, T.StringType(), True)])


def judge(
    bronze: DataFrame,
    regions: DataFrame,
    as_of: datetime | str | Column,
    root: str,
    run: str,
    limits: Mapping[str, int] | None = None,
) -> dict[str, int]:
    """Judge landed rows; valid and quarantined rows become the two partitions of one table, in one job.

    A row with more bytes in a raw column than `limits` allows is quarantined, with the reason. Returns the
    counts of rows read, valid and quarantined, which the job takes while it writes.
    """
    too_long = max_length_rules({c: n for c, n in (limits or {}).items() if c in REQUIRED_COLUMNS})
    judged = validation.judge_tickets(validation.check_tickets(bronze, regions, as_of, more_rules=too_long))
    outcome = F.when(validation.passed(), VALID).otherwise(QUARANTINED)
    counts = Observation()
    observed = judged.withColumn(OUTCOME, outcome).observe(
        counts, F.count(F.lit(1)).alias("rows_read"), F.count_if(validation.passed()).alias("rows_valid"),
        F.count_if(~validation.passed()).alias("rows_quarantined"),
    )
    layers.write_run(observed, f"{root}/judged", run, partition_by=[OUTCOME])
    return counts.get


def _read_outcome(spark: SparkSession, root: str, outcome: str, run: str | None) -> DataFrame:
    judged = layers.read_layer(spark, f"{root}/judged", run)
    return judged.where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def read_validated(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    return validation.typed_layout(_read_outcome(spark, root, VALID, run))


def read_quarantine(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    return validation.raw_layout(_read_outcome(spark, root, QUARANTINED, run))


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    """The stored fact with derived columns and names; the input of the reports."""
    fact = layers.read_layer(spark, f"{root}/{FACT_TABLE}", schema=schemas.FACT)
    return load.gold_tickets(fact, reference_data.dim_regions(spark), reference_data.dim_categories(spark))


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The run log folded to one row per run; the input of the run reports."""
    return runlog.run_state(_run_log(spark, root))


def _run_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUN_EVENTS).parquet(f"{root}/run_log")


def _log(events: DataFrame, root: str) -> None:
    events.coalesce(1).write.mode("append").parquet(f"{root}/run_log")


def logged_stage(
    spark: SparkSession, root: str, run: str, stage_name: str, work: Callable[[], DataFrame]
) -> None:
    """Run one stage between its start and its end event. `work` returns one row of metrics.

    The run id is the clock in microseconds: it rises from attempt to attempt, and drivers that
    work at the same time need not agree on a counter.
    """
    stage = lookup_stage_ids(
        reference_data.stages(spark), reference_data.pipelines(spark), PIPELINE, stage_name
    ).first()["stage_id"]
    ids = {"run_id": F.lit(time.time_ns() // 1000), "execution_id": F.lit(run), "stage_id": F.lit(stage)}
    this_run = spark.range(1).withColumns(ids)
    _log(runlog.start_events(this_run, F.localtimestamp()), root)
    try:
        metrics = work()
        ended = metrics.select(runlog.metrics_json(*metrics.columns).alias("_metrics")).withColumns(ids)
        _log(runlog.success_events(ended, F.localtimestamp(), F.col("_metrics")), root)
    except Exception as error:
        _log(runlog.failure_events(this_run, F.localtimestamp(), F.lit(str(error))), root)
        raise


def _one_row(spark: SparkSession, values: Mapping[str, object]) -> DataFrame:
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])


def land_run(spark: SparkSession, raw: DataFrame, root: str, run: str) -> None:
    """Raw rows of one run, from whatever source, into the bronze layer."""

    def work() -> DataFrame:
        stored = land(raw, root, run)
        return stored.agg(F.count(F.lit(1)).alias("rows_generated"), F.lit(run).alias("output_file"))

    logged_stage(spark, root, run, "Generate Raw Data", work)


def validate_run(
    spark: SparkSession,
    root: str,
    run: str,
    as_of: datetime | str | Column | None = None,
    limits: Mapping[str, int] | None = None,
) -> None:
    """Verdicts on the landed rows of one run; `as_of` is now unless given. Rows over `limits` are quarantined."""

    def work() -> DataFrame:
        bronze = layers.read_layer(spark, f"{root}/bronze", run)
        validation.require_rows(validation.require_columns(bronze))
        counts = judge(
            bronze, reference_data.dim_regions(spark), F.localtimestamp() if as_of is None else as_of, root, run, limits
        )
        rate = percentage(F.col("rows_valid"), F.col("rows_read")).alias("validation_pass_rate")
        summary = _one_row(spark, counts).select("*", rate)
        name = F.lit(f"{run}/")
        return summary.withColumns(
            {
                "valid_output_file": F.when(F.col("rows_valid") > 0, F.concat(name, F.lit(VALID))).otherwise(""),
                "quarantine_output_file": F.when(
                    F.col("rows_quarantined") > 0, F.concat(name, F.lit(QUARANTINED))
                ).otherwise(""),
            }
        )

    logged_stage(spark, root, run, "Validate Bronze Data", work)


def enrich_run(
    spark: SparkSession,
    root: str,
    run: str,
    lexicon: Mapping[str, float] | DataFrame,
    score: Callable[[str], str | None] | None = None,
    parallel_callers: int | None = None,
    modifiers: Modifiers | None = None,
    score_batch: Callable[[Sequence[str]], Sequence[str | None]] | None = None,
    **scoring: object,
) -> None:
    """Silver rows of one run. Model replies are stored before use, so no later step repeats a call.

    The lexicon is a dictionary or a table (`word`, `polarity`) of any size. Retries and delay come
    from the configuration table unless given. With `score_batch` instead of `score`, prompts go to the model in
    batches, and the store of replies below `root` serves all runs: a run that is repeated after a failure, and a
    text that came before, call the model only for what has no reply yet.
    """

    def work() -> DataFrame:
        valid = read_validated(spark, root, run)
        if score_batch is not None:
            config = reference_data.configuration(spark)
            retries = int(reference_data.config_value(config, "MAX_RETRIES"))
            options = {"max_retries": retries, "parallel_callers": parallel_callers, **scoring}
            replied = score_tickets_from_store(valid, score_batch, f"{root}/reply_store", **options)
        elif score is None:
            replied = valid.withColumn("model_reply", F.lit(None).cast("string"))
        else:
            config = reference_data.configuration(spark)
            options = {
                "max_retries": int(reference_data.config_value(config, "MAX_RETRIES")),
                "delay_seconds": int(reference_data.config_value(config, "API_DELAY_SECONDS")),
                **scoring,
            }
            scored = score_tickets(valid, score, parallel_callers=parallel_callers, **options)
            layers.write_run(scored, f"{root}/replies", run)
            replied = layers.read_layer(spark, f"{root}/replies", run, _with_run(scored.schema))
        if isinstance(lexicon, DataFrame):
            replied = score_by_lexicon(
                replied, "customer_text", ROW_ID, lexicon, "_local_score", modifiers, F.col("model_reply").isNull()
            )
            local_score = F.col("_local_score")
        else:
            local_score = lexicon_polarity(F.col("customer_text"), lexicon, modifiers)
        silver = enrich_tickets(replied, reference_data.dim_categories(spark), local_score)
        counts = Observation()
        observed = silver.drop("_local_score").observe(counts, *enrichment_counts())
        layers.write_run(observed, f"{root}/silver", run)
        return with_model_share(_one_row(spark, counts.get)).withColumn(
            "output_file", F.when(F.col("rows_enriched") > 0, F.lit(run)).otherwise("")
        )

    logged_stage(spark, root, run, "AI Enrichment", work)


def load_run(
    spark: SparkSession,
    root: str,
    run: str,
    ingested_at: datetime | str | Column | None = None,
    rules: Sequence[Rule] | None = None,
) -> None:
    """Fact rows of one run, replacing an earlier load of it. Keys have no gaps within a load and continue
    after the largest one stored by the other runs, whether those loads were logged or not; one load at
    a time may run.

    The rows are checked and counted while they are written beside the table, and take the run's place
    when all are in order. A row that breaks one of `rules` (the constraints of the fact table, `fact_rules()`,
    unless given) fails the load and nothing changes; give `validate_run` the limits, and no such row comes here.
    """

    def work() -> DataFrame:
        path = f"{root}/{FACT_TABLE}"
        last = 0
        if layers.exists(spark, path):
            others = layers.read_layer(spark, path, schema=schemas.FACT).where(F.col(EXECUTION_ID) != run)
            last = others.agg(F.max(TICKET_ID)).first()[0] or 0
        fact = load.prepare_fact(
            load.with_dense_key(layers.read_layer(spark, f"{root}/silver", run), TICKET_ID, last),
            reference_data.dim_regions(spark),
            reference_data.dim_categories(spark),
            F.localtimestamp() if ingested_at is None else ingested_at,
            key=TICKET_ID,
        )
        counts, broken = Observation(), F.when(F.col(REASON) != "", F.col(REASON))
        judged = apply_rules(fact, fact_rules() if rules is None else rules).observe(
            counts, F.count(F.lit(1)).alias("rows_loaded"), F.lit(FACT_TABLE).alias("target_table"),
            F.max(TICKET_ID).alias("last_ticket_id"), F.count(broken).alias("rows_broken"), F.min(broken).alias("reason"),
        )
        staged = layers.stage_run(judged.drop(REASON, FAILED_RULES), path)
        found = counts.get
        if found.pop("rows_broken"):
            files.delete(spark, staged)
            raise ValueError(f"constraint violated: {found['reason']}")
        found.pop("reason")
        layers.publish_run(spark, staged, path, run)
        return _one_row(spark, found)

    logged_stage(spark, root, run, "Load to Lakehouse", work)


def run_all(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    run: str,
    lexicon: Mapping[str, float] | DataFrame,
    score: Callable[[str], str | None] | None = None,
    as_of: datetime | str | Column | None = None,
    limits: Mapping[str, int] | None = None,
    **scoring: object,
) -> None:
    """All four stages of one run, one after the other; the first failure ends it.

    With `limits` (bytes by column), rows over them are quarantined and all others load; without, one row
    over `FACT_LENGTHS` refuses the load.
    """
    land_run(spark, raw, root, run)
    validate_run(spark, root, run, as_of, limits)
    enrich_run(spark, root, run, lexicon, score, **scoring)
    load_run(spark, root, run, as_of, None if limits is None else fact_rules(limits))

"""Every registered query: a function of (spark, folder of the driver's tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.fixed_values import FACT_LENGTHS, RUN_STATUSES
from ticketmill.functions.tickets import unanswered_risk
from ticketmill.operators import constraints, load, reports, runlog, validation
from ticketmill.operators.enrichment import (
    build_prompt,
    enrich_tickets,
    enrichment_summary,
    lexicon_polarity,
    parse_replies,
    score_by_lexicon,
    with_keyword_category,
)
from ticketmill.operators.dedup import drop_known
from ticketmill.operators.lookup import reference_mapping, reference_values
from ticketmill.operators.rules import apply_rules
from ticketmill.operators.scoring import score_tickets
from ticketmill.plans import batch
from ticketmill.plans.shared import new_folder
from ticketmill.schemas import EXECUTION_ID, ROW_ID
from ticketmill.sources import layers, reference_data
from ticketmill.streaming import tickets as streams
from verification import event_views
from verification.event_views import AS_OF, LEXICON, table

DOCUMENT_LEXICON = {"the": 0.1, "und": -0.1, "license": -0.5, "data": 0.3, "report": 0.2, "der": -0.2, "la": 0.4}
DOCUMENT_RULES = [
    ("Legal", ["license", "copyright", "warranty"]),
    ("Contact", ["@", "phone", "http"]),
    ("German", [" und ", " der ", " die "]),
]


def tickets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_views.tickets(table(spark, sf_dir, "events"))


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.check_tickets(tickets_raw(spark, sf_dir), reference_data.dim_regions(spark), AS_OF)


def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir).select(ROW_ID, "failure_reason")


def valid_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.valid_tickets(checked(spark, sf_dir))


def quarantined_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.quarantined_tickets(checked(spark, sf_dir)).drop("failed_rules")


def judged_by_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of the split in one table: which row is valid, and why another is not."""
    judged = validation.judge_tickets(checked(spark, sf_dir))
    return judged.select(ROW_ID, validation.passed().alias("is_valid"), "failure_reason")


def judged_with_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a third of all rows being copies of one ticket."""
    hot = F.col(ROW_ID) % 3 == 0
    raw = tickets_raw(spark, sf_dir).withColumns(
        {
            "email_address": F.when(hot, "hot@example.org").otherwise(F.col("email_address")),
            "customer_text": F.when(hot, "Everyone sends this").otherwise(F.col("customer_text")),
        }
    )
    judged = validation.judge_tickets(validation.check_tickets(raw, reference_data.dim_regions(spark), AS_OF))
    return judged.select(ROW_ID, "failure_reason")


def _checked_in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked tickets of many runs: a run takes in 500 events, as a file of one day would."""
    raw = tickets_raw(spark, sf_dir).withColumn(EXECUTION_ID, F.floor(F.col(ROW_ID) / 500).cast("string"))
    return validation.check_tickets(raw, reference_data.dim_regions(spark), AS_OF)


def valid_tickets_in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.valid_tickets(_checked_in_runs(spark, sf_dir))


def validation_summary_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validation_summary(_checked_in_runs(spark, sf_dir), [EXECUTION_ID])


def failure_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.failure_reason_counts(checked(spark, sf_dir))


def failure_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.failure_rule_counts(checked(spark, sf_dir))


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validation_summary(checked(spark, sf_dir))


def not_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = constraints.not_null_rules(["email_address", "created_at", "customer_text", "region"])
    judged = apply_rules(tickets_raw(spark, sf_dir), rules)
    return judged.where(F.col("failure_reason") != "").select(ROW_ID, "failure_reason")


def max_length_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(table(spark, sf_dir, "documents"), constraints.max_length_rules({"text": 1000, "lang": 2}))
    return judged.where(F.col("failure_reason") != "").select("doc_id", "failure_reason")


def in_set_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run statuses that the log may not hold, on a log whose types are taken as statuses."""
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "view", "SUCCESS")
    log = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "click", None).otherwise(F.coalesce(status, "event_type")).alias("run_status")
    )
    judged = apply_rules(log, constraints.in_set_rules({"run_status": RUN_STATUSES}))
    return judged.where(F.col("failure_reason") != "").select("event_id", "failure_reason")


def fact_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the fact table would refuse: documents as ticket texts, with some values missing."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 17 != 0, F.concat(F.col("source"), F.lit("@x.org"))).alias("email_address"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"),
        F.col("text").alias("customer_text"),
        F.when(F.col("doc_id") % 13 != 0, F.lit(0.5)).alias("sentiment_score"),
        F.repeat("lang", F.lit(20) + F.col("doc_id").cast("int") % 10).alias("analysis_source"),
    )
    return constraints.violations(rows, constraints.fact_rules()).select("doc_id", "failure_reason")


def run_log_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run events with unknown statuses and missing stages."""
    log = run_log(spark, sf_dir).withColumns(
        {
            "stage_id": F.when(F.col("run_id") % 50 != 0, F.col("stage_id")),
            "run_status": F.when(F.col("run_id") % 30 == 0, F.lit("LOST")).otherwise(F.col("run_status")),
        }
    )
    return constraints.violations(log, constraints.run_rules()).select("run_id", "failure_reason")


def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicate_keys(tickets_raw(spark, sf_dir), ["email_address", "customer_text"])


def unique_check_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def referential_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are the children here: only some of them have a label."""
    orphans = constraints.orphans(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id"
    )
    return orphans.select("doc_id", "lang", "source")


def referential_check_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose user is no supplier: a large child with few, heavily repeated keys."""
    orphans = constraints.orphans(
        table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "supplier"), "s_suppkey"
    )
    return orphans.select("event_id", "user_id")


def reference_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of a column, and one value per key of a table that repeats keys."""
    orders = table(spark, sf_dir, "orders")
    mapping = reference_mapping(orders, "o_custkey", "o_orderkey")
    known = reference_values(table(spark, sf_dir, "customer"), "c_custkey")
    return mapping.join(known, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


def replied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_views.replies(valid_tickets(spark, sf_dir))


def parse_model_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_replies(replied(spark, sf_dir), "model_reply", reference_data.dim_categories(spark))
    return parsed.select(ROW_ID, "model_reply", "model_score", "model_category")


def keyword_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_keyword_category(tickets_raw(spark, sf_dir)).select(ROW_ID, "category")


def keyword_categories_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return with_keyword_category(documents, "text", DOCUMENT_RULES, "Other").select("doc_id", "category")


def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = lexicon_polarity(F.col("customer_text"), LEXICON)
    return valid_tickets(spark, sf_dir).select(ROW_ID, score.alias("sentiment_score"))


def lexicon_sentiment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = lexicon_polarity(F.col("text"), DOCUMENT_LEXICON)
    return table(spark, sf_dir, "documents").select("doc_id", score.alias("sentiment_score"))


def lexicon_table_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon as a table: every word of the benchmark texts, scored by its length."""
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(F.split(F.lower("text"), "[^\\p{L}\\p{N}']+")).alias("word")
    )
    polarity = ((F.length("word") % 21 - 10) / 10).cast("decimal(9,6)")
    lexicon = words.where(F.col("word") != "").distinct().withColumn("polarity", polarity)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_by_lexicon(documents, "text", "doc_id", lexicon).select("doc_id", "sentiment_score")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_tickets(
        replied(spark, sf_dir),
        reference_data.dim_categories(spark),
        lexicon_polarity(F.col("customer_text"), LEXICON),
    )


def enrichment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment_summary(silver(spark, sf_dir))


def length_scorer() -> Callable[[str], str]:
    """A stand-in for a model: the answer follows from the length of the prompt, some lengths fail."""

    def score(prompt: str) -> str:
        n = len(prompt)
        if n % 4 == 0:
            raise TimeoutError("no answer")
        category = ("Technical", "Billing", "Account", "Feedback", "How-To Question")[n % 5]
        return f"{(n % 21 - 10) / 10}|{category}"

    return score


def model_scoring_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_tickets(
        valid_tickets(spark, sf_dir), length_scorer(), max_retries=2, delay_seconds=0, sleep=lambda seconds: None
    )
    enriched = enrich_tickets(
        scored, reference_data.dim_categories(spark), lexicon_polarity(F.col("customer_text"), LEXICON)
    )
    return enriched.select(ROW_ID, "sentiment_score", "category", "analysis_source")


def prompt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_tickets(spark, sf_dir).select(ROW_ID, build_prompt(F.col("customer_text")).alias("prompt"))


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.prepare_fact(
        silver(spark, sf_dir), reference_data.dim_regions(spark), reference_data.dim_categories(spark), AS_OF
    )


def gold_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.gold_tickets(
        fact_rows(spark, sf_dir), reference_data.dim_regions(spark), reference_data.dim_categories(spark)
    )


def generated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of row key are unique over the fact, and the generated one starts after the last."""
    key = load.content_key(F.col("email_address"), F.col("customer_text"))
    keyed = load.with_generated_key(fact_rows(spark, sf_dir), "ticket_id", start_after=1000).withColumn("key", key)
    per_key = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("ticket_id").alias("least"))
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("content_keys"),
        F.count_if(F.col("least") <= 1000).alias("too_small"),
    )


def severity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.severity_report(gold_tickets(spark, sf_dir))


def category_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_sentiment(gold_tickets(spark, sf_dir))


def region_escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    risk = unanswered_risk(F.col("severity"), F.col("first_response_at"))
    return reports.region_escalation(gold_tickets(spark, sf_dir), risk)


def open_vs_responded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.open_vs_responded(gold_tickets(spark, sf_dir))


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.source_counts(gold_tickets(spark, sf_dir))


def hourly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_trend(gold_tickets(spark, sf_dir))


def _targets(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES ('P1-URGENT', 4.0D), ('P2-HIGH', 8.0D), ('P3-NORMAL', 12.5D) AS t(severity, target_hours)"
    )


def sla_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sla_performance(gold_tickets(spark, sf_dir), _targets(spark))


def sla_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sla_performance(gold_tickets(spark, sf_dir), _targets(spark), by=["region", "severity"])


def config_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several keys of a configuration table kept in `supplier`, one of them unknown."""
    config = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("SUPPLIER_"), F.col("s_suppkey")).alias("config_key"), F.col("s_name").alias("config_value")
    )
    return reference_data.config_values(config, ["SUPPLIER_1", "SUPPLIER_7", "NOT_A_KEY"])


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_views.run_events(table(spark, sf_dir, "events"))


def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_state(run_log(spark, sf_dir))


def stage_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with the names of their stage and pipeline, counted."""
    named = runlog.with_stage_names(
        run_state(spark, sf_dir), reference_data.stages(spark), reference_data.pipelines(spark)
    )
    return named.groupBy("pipeline_code", "stage_order", "stage_name").agg(F.count(F.lit(1)).alias("run_count"))


def latest_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.latest_attempts(run_state(spark, sf_dir)).select(
        "execution_id", "stage_id", "run_id", "run_status"
    )


def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_health(run_state(spark, sf_dir))


def stage_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.stage_performance(run_state(spark, sf_dir))


def validation_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.validation_over_runs(run_state(spark, sf_dir), stage_id=2)


def ai_usage_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.ai_usage_over_runs(run_state(spark, sf_dir), stage_id=3)


def runtime_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.runtime_trend(run_state(spark, sf_dir))


def failed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.failed_runs(run_state(spark, sf_dir))


def run_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_lineage(run_state(spark, sf_dir), reference_data.stage_names())


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tickets through a CSV file and back; document texts ride along for their odd characters."""
    path = new_folder(spark, "csv")
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), F.col("text").alias("extra"))
    raw = tickets_raw(spark, sf_dir)
    layers.write_csv(raw.join(documents, F.col(ROW_ID) == F.col("_doc"), "left").drop("_doc"), path)
    return layers.read_bronze_csv(spark, path).withColumn(ROW_ID, F.col(ROW_ID).cast("bigint"))


def _runs_of_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = F.concat(F.lit("2024"), F.substring(F.col("created_at").cast("string"), 6, 2), F.lit("_"), F.col("region_id"))
    return fact_rows(spark, sf_dir).withColumn(EXECUTION_ID, run)


def partition_overwrite_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all runs, load one of them again with other scores, then empty another one."""
    path = new_folder(spark, "fact")
    layers.write_runs(_runs_of_fact(spark, sf_dir), path)
    once = layers.read_layer(spark, path, "202401_2").withColumn("sentiment_score", F.lit(1.0))
    staged = new_folder(spark, "staged")
    once.write.parquet(staged)
    again = spark.read.parquet(staged)
    layers.write_runs(again, path)
    layers.write_run(again.limit(0), path, "202401_3")
    return layers.read_layer(spark, path)


def insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the runs of two regions, then offer everything: only unknown tickets are added."""
    path = new_folder(spark, "fact")
    fact = _runs_of_fact(spark, sf_dir)
    layers.append_runs(fact.where(F.col("region_id") <= 2).withColumn("sentiment_score", F.lit(0.0)), path)
    layers.append_new(fact, path, ["email_address", "customer_text"])
    return layers.read_layer(spark, path)


def append_known_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, offered to the list of customers of each market segment: the lists that do not know its customer.

    All customers count, under the keys as they are, compared as text."""
    known = table(spark, sf_dir, "customer").select("c_mktsegment", F.col("c_custkey").cast("string").alias("customer"))
    orders = table(spark, sf_dir, "orders").withColumn("customer", F.col("o_custkey").cast("string"))
    offered = orders.crossJoin(F.broadcast(known.select("c_mktsegment").distinct()))
    return drop_known(offered, known, ["c_mktsegment", "customer"]).select("o_orderkey", "o_custkey", "c_mktsegment")


def stream_hourly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.run_hourly_trend(streams.typed_stream(_event_stream(spark, sf_dir, files_per_batch=2)), new_folder(spark, "trend"))


def stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with several files in each batch."""
    stream = streams.typed_stream(_event_stream(spark, sf_dir, files=12, files_per_batch=5))
    return streams.run_hourly_trend(stream, new_folder(spark, "trend"))


def stream_ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _ingested(spark, sf_dir)
    return batch.read_validated(spark, root).drop(EXECUTION_ID)


def stream_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _ingested(spark, sf_dir)
    return batch.read_quarantine(spark, root).drop(EXECUTION_ID, "failed_rules")


def stream_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets arriving in several micro-batches; the newest copy over all of them stays."""
    root = _ingested(spark, sf_dir, files_per_batch=2)
    return streams.current_tickets(batch.read_validated(spark, root)).drop(EXECUTION_ID)


def stream_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ticket key over all batches; which copy comes first is up to the stream."""
    stream = streams.typed_stream(_event_stream(spark, sf_dir, files_per_batch=3))
    return streams.run_first_copies(stream, new_folder(spark, "first")).select("email_address", "customer_text")


def _event_stream(spark: SparkSession, sf_dir: str, files: int = 8, files_per_batch: int | None = None) -> DataFrame:
    """Raw tickets as a stream of files, rows in any order; without a limit all files are one batch."""
    source = new_folder(spark, "arriving")
    tickets_raw(spark, sf_dir).repartition(files, ROW_ID).write.parquet(source)
    schema = spark.read.parquet(source).schema
    return streams.read_stream(spark, source, schema, format="parquet", files_per_batch=files_per_batch)


def _ingested(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> str:
    root = new_folder(spark, "lake")
    streams.ingest(
        _event_stream(spark, sf_dir, files_per_batch=files_per_batch), reference_data.dim_regions(spark), AS_OF, root
    ).awaitTermination()
    return root


def run_from_raw_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored run: raw rows land, are judged, enriched by the stand-in model and loaded; then a report."""
    root, run = new_folder(spark, "lake"), "20240201_000000"
    batch.run_all(
        spark, tickets_raw(spark, sf_dir), root, run, LEXICON, length_scorer(), AS_OF, FACT_LENGTHS, max_retries=1,
        delay_seconds=0, sleep=lambda seconds: None,
    )
    return reports.severity_report(batch.read_gold(spark, root))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tickets_raw": tickets_raw,
    "validate_reasons": validate_reasons,
    "valid_tickets": valid_tickets,
    "quarantined_tickets": quarantined_tickets,
    "judged_by_outcome": judged_by_outcome,
    "judged_with_hot_key": judged_with_hot_key,
    "valid_tickets_in_runs": valid_tickets_in_runs,
    "validation_summary_by_run": validation_summary_by_run,
    "failure_reason_counts": failure_reason_counts,
    "failure_rule_counts": failure_rule_counts,
    "validation_summary": validation_summary,
    "not_null_check": not_null_check,
    "max_length_check": max_length_check,
    "in_set_check": in_set_check,
    "fact_check": fact_check,
    "run_log_check": run_log_check,
    "unique_check": unique_check,
    "unique_check_lineitem": unique_check_lineitem,
    "referential_check": referential_check,
    "referential_check_events": referential_check_events,
    "reference_scan": reference_scan,
    "parse_model_reply": parse_model_reply,
    "keyword_category": keyword_categories,
    "keyword_category_documents": keyword_categories_documents,
    "lexicon_sentiment": lexicon_sentiment,
    "lexicon_sentiment_documents": lexicon_sentiment_documents,
    "lexicon_table_sentiment": lexicon_table_sentiment,
    "enriched_tickets": silver,
    "enrichment_summary": enrichment_totals,
    "model_scoring_batch": model_scoring_batch,
    "prompt_text": prompt_text,
    "fact_rows": fact_rows,
    "gold_tickets": gold_tickets,
    "generated_keys": generated_keys,
    "severity_report": severity_report,
    "category_sentiment": category_sentiment,
    "region_escalation": region_escalation,
    "open_vs_responded": open_vs_responded,
    "source_counts": source_counts,
    "hourly_trend": hourly_trend,
    "sla_by_severity": sla_by_severity,
    "sla_by_region": sla_by_region,
    "config_values": config_values,
    "stage_lookup": stage_lookup,
    "run_state": run_state,
    "latest_attempt": latest_attempt,
    "run_health": run_health,
    "stage_performance": stage_performance,
    "validation_over_runs": validation_over_runs,
    "ai_usage_over_runs": ai_usage_over_runs,
    "runtime_trend": runtime_trend,
    "failed_runs": failed_runs,
    "run_lineage": run_lineage,
    "csv_round_trip": csv_round_trip,
    "partition_overwrite_rerun": partition_overwrite_rerun,
    "insert_only_merge": insert_only_merge,
    "append_known_keys": append_known_keys,
    "run_from_raw_to_gold": run_from_raw_to_gold,
    "stream_hourly_trend": stream_hourly_trend,
    "stream_hourly_counts": stream_hourly_counts,
    "stream_ingest_valid": stream_ingest_valid,
    "stream_ingest_quarantine": stream_ingest_quarantine,
    "stream_dedup_latest": stream_dedup_latest,
    "stream_first_copies": stream_first_copies,
}

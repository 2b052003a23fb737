"""Registered queries of loads, reruns, streams and texts; the others stand in `spark_queries`."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.fixed_values import FACT_LENGTHS, FACT_TABLE, NA_TOKENS
from ticketmill.functions.text import is_blank, null_missing, strip
from ticketmill.functions.timestamps import execution_id, parse_timestamp, second_label
from ticketmill.operators import runlog, validation
from ticketmill.operators.enrichment import Modifiers, lexicon_polarity, score_by_lexicon
from ticketmill.operators.scoring import score_tickets_from_store
from ticketmill.plans import batch
from ticketmill.plans.shared import new_folder
from ticketmill.schemas import EXECUTION_ID, FACT, ROW_ID, RUN_EVENTS, TICKET_ID
from ticketmill.sources import files, layers, reference_data, versions
from ticketmill.streaming import tickets as streams
from verification import spark_queries as base
from verification.event_views import AS_OF, LEXICON, table

KEYS = ["email_address", "customer_text"]
MODIFIERS = Modifiers(negations=["of", "von"], strengtheners={"and": 1.5, "in": 1.2, "the": 0.8})


def upsert_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads of one table by key: all rows, newer ones, older ones, and equally new ones with other scores.

    The first version is read again after all of them."""
    path, fact = new_folder(spark, "keyed"), base.fact_rows(spark, sf_dir)

    def load(rows: DataFrame, score: Column, hours: int, merge_at: float) -> None:
        moved = F.col("created_at") + F.make_dt_interval(F.lit(0), F.lit(hours))
        changed = rows.withColumns({"sentiment_score": score, "created_at": moved})
        versions.upsert(changed, path, KEYS, "created_at", buckets=8, merge_at=merge_at)

    load(fact, F.lit(0.0), 0, 0)
    load(fact.where("region_id >= 3"), F.col("sentiment_score"), 1, 0.9)
    load(fact.where("region_id = 1"), F.lit(9.0), -1, 0.9)
    load(fact.where("region_id = 2"), F.lit(-1.0), 0, 0.1)
    first, last = (versions.read(spark, path, v).withColumn("version", F.lit(v)) for v in (1, 4))
    return first.unionByName(last).drop("ingestion_date")


def rerun_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over all tickets, each judged again on rows of one outcome: the other outcome is empty then."""
    root, raw = new_folder(spark, "lake"), base.tickets_raw(spark, sf_dir)
    regions, unknown = reference_data.dim_regions(spark), F.coalesce(F.col("region") == "XX-NOWHERE", F.lit(True))
    valid = base.valid_tickets(spark, sf_dir).select(ROW_ID)
    for run, again in (("r1", raw.join(valid, ROW_ID, "left_semi")), ("r2", raw.where(unknown))):
        for rows in (raw, again):
            batch.judge(batch.land(rows, root, run), regions, AS_OF, root, run)
    outcomes = {"valid": batch.read_validated(spark, root), "quarantined": batch.read_quarantine(spark, root)}
    named = [df.select(EXECUTION_ID, ROW_ID, F.lit(name).alias("outcome")) for name, df in outcomes.items()]
    return named[0].unionByName(named[1])


def stream_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over half of the tickets, and one over the others that begins anew in the same folders."""
    root, raw = new_folder(spark, "lake"), base.tickets_raw(spark, sf_dir)
    for half in (0, 1):
        source = new_folder(spark, "arriving")
        raw.where(F.col(ROW_ID) % 2 == half).repartition(4, ROW_ID).write.parquet(source)
        stream = streams.read_stream(spark, source, raw.schema, format="parquet")
        streams.ingest(stream, reference_data.dim_regions(spark), AS_OF, root).awaitTermination()
        files.move(spark, f"{root}/_checkpoint", f"{root}/_checkpoint_{half}")
    return layers.read_layer(spark, f"{root}/bronze").drop(EXECUTION_ID)


def stream_current_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of newest copies that a stream keeps up to date, batch by batch."""
    root = new_folder(spark, "lake")
    stream = base._event_stream(spark, sf_dir, files_per_batch=2)
    streams.ingest(stream, reference_data.dim_regions(spark), AS_OF, root, keep_current=True).awaitTermination()
    return streams.read_current(spark, root)


def quarantined_by_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = validation.judge_tickets_by_filter(
        base.tickets_raw(spark, sf_dir), reference_data.dim_regions(spark), AS_OF
    )
    return validation.split_judged(judged)[1].drop("failed_rules")


def model_scoring_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run whose model answers every other prompt only, and a second one that asks for the rest."""
    store, valid = new_folder(spark, "replies"), base.valid_tickets(spark, sf_dir)
    score = base.length_scorer()

    def answer(prompt: str) -> str | None:
        return None if len(prompt) % 4 == 0 else score(prompt)

    def half(prompts: Sequence[str]) -> list[str | None]:
        return [answer(p) if len(p) % 2 else None for p in prompts]

    def whole(prompts: Sequence[str]) -> list[str | None]:
        return [answer(p) for p in prompts]

    options = {"slices": 2, "max_retries": 1, "sleep": lambda seconds: None}
    score_tickets_from_store(valid, half, store, **options)
    return score_tickets_from_store(valid, whole, store, **options).select(ROW_ID, "model_reply")


def lexicon_modified_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document scores with negations and strengtheners, by the dictionary and by the table."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = spark.createDataFrame(list(base.DOCUMENT_LEXICON.items()), "word string, polarity double")
    inline = documents.withColumn("inline_score", lexicon_polarity(F.col("text"), base.DOCUMENT_LEXICON, MODIFIERS))
    scored = score_by_lexicon(inline, "text", "doc_id", lexicon, "table_score", MODIFIERS)
    return scored.select("doc_id", "inline_score", "table_score")


def lenient_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written in twelve ways, and read again."""
    events = table(spark, sf_dir, "events").withColumn("_text", second_label(F.col("ts")))
    y, mo, d, h, mi, s = (F.substring("_text", at, n) for at, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2)))
    names = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
    month = F.element_at(F.array(*map(F.lit, names)), mo.cast("int"))
    hour = h.cast("int")
    twelve = F.lpad(F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string"), 2, "0")
    clock = F.concat(twelve, F.lit(":"), mi, F.when(hour < 12, " AM").otherwise(" PM"))
    short, plain = F.substring(month, 1, 3), d.cast("int").cast("string")
    written = [
        F.concat(mo, F.lit("/"), d, F.lit("/"), y, F.lit(" "), clock),
        F.concat(y, F.lit("-"), mo, F.lit("-"), d, F.lit(" "), clock),
        F.concat(plain, F.lit(" "), short, F.lit(" "), y, F.lit(" "), clock),
        F.concat(mo, F.lit("/"), d, F.lit("/"), y, F.lit(" "), h, F.lit(":"), mi, F.lit(":"), s, F.lit(".123")),
        F.concat(y, F.lit("/"), mo, F.lit("/"), d, F.lit(" "), h, F.lit(":"), mi, F.lit(":"), s, F.lit(".5")),
        F.concat(y, mo, d, F.lit("T"), h, mi, s),
        F.concat_ws(".", y, mo, d),
        F.concat_ws("/", mo, d, F.substring(y, 3, 2)),
        F.concat(month, F.lit(" "), y),
        F.concat(F.lit("Tue, "), d, F.lit(" "), short, F.lit(" "), y, F.lit(" "), F.concat_ws(":", h, mi, s)),
        F.concat(F.lit("Tuesday, "), month, F.lit(" "), plain, F.lit(", "), y),
        F.concat(F.lit("  "), F.concat_ws("-", y, mo, d), F.lit("T"), F.concat_ws(":", h, mi, s), F.lit("Z ")),
    ]
    chosen = F.element_at(F.array(*written), (F.col("event_id") % len(written) + 1).cast("int"))
    return events.select("event_id", parse_timestamp(chosen).alias("parsed"))


def ticket_ids_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of one fact table, one of them twice, and a run that was written without a load in between."""
    root = new_folder(spark, "lake")
    path = f"{root}/{FACT_TABLE}"
    own = F.concat(F.lit("r"), (F.col(ROW_ID) % 3).cast("string"))
    layers.write_runs(base.silver(spark, sf_dir).withColumn(EXECUTION_ID, own), f"{root}/silver")
    batch.load_run(spark, root, "r0", AS_OF)
    first = layers.read_layer(spark, path, "r0", FACT)
    layers.write_run(first.withColumn(TICKET_ID, F.col(TICKET_ID) + 1_000_000), path, "unlogged")
    for run in ("r1", "r2", "r1"):
        batch.load_run(spark, root, run, AS_OF)
    return layers.read_layer(spark, path, schema=FACT).groupBy(EXECUTION_ID).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(TICKET_ID).alias("ids"),
        F.min(TICKET_ID).alias("first_id"), F.max(TICKET_ID).alias("last_id"),
    )


def source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets in eight CSV files, numbered as they stand there."""
    path, placed = new_folder(spark, "csv"), new_folder(spark, "placed")
    raw = base.tickets_raw(spark, sf_dir).repartitionByRange(8, ROW_ID).sortWithinPartitions(ROW_ID)
    layers.write_csv(raw.withColumnRenamed(ROW_ID, "event_id"), path)
    layers.with_source_place(layers.read_bronze_csv(spark, path, multi_line=False)).write.parquet(placed)
    numbered = layers.numbered_in_source_order(spark.read.parquet(placed))
    return layers.in_source_order(numbered).select(F.col("event_id").cast("bigint"), ROW_ID)


def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation results of many runs as JSON in a stored run log, read out of it again as variants."""
    summary = validation.validation_summary(base._checked_in_runs(spark, sf_dir), [EXECUTION_ID])
    measures = [c for c in summary.columns if c != EXECUTION_ID]
    ended = summary.select(
        F.col(EXECUTION_ID).cast("long").alias("run_id"), EXECUTION_ID, F.lit(2).cast("long").alias("stage_id"),
        runlog.metrics_json(*measures).alias("_metrics"),
    )
    path = new_folder(spark, "run_log")
    runlog.success_events(ended, F.lit(AS_OF).cast("timestamp_ntz"), F.col("_metrics")).write.parquet(path)
    runs = runlog.run_state(spark.read.schema(RUN_EVENTS).parquet(path))
    kinds = {name: "double" if name.endswith("rate") else "bigint" for name in [*measures, "not_measured"]}
    return runs.select(EXECUTION_ID, *[runlog.metric(name, kind).alias(name) for name, kind in kinds.items()])


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages of a stored run have counted while they wrote, summed by stage."""
    root, run = new_folder(spark, "lake"), "20240201_000000"
    batch.run_all(
        spark, base.tickets_raw(spark, sf_dir), root, run, LEXICON, base.length_scorer(), AS_OF, FACT_LENGTHS,
        max_retries=1, delay_seconds=0, sleep=lambda seconds: None,
    )
    names = ["rows_generated", "rows_read", "rows_valid", "rows_quarantined", "rows_enriched", "gemini_enrichments", "rows_loaded", "last_ticket_id"]
    found = runlog.metrics_over_runs(batch.read_runs(spark, root), {name: "bigint" for name in names})
    return found.select("stage_id", *names)


def conditional_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes that have rows are written, others leave no folder: tickets of each region, and of an unknown one."""
    checked = base.checked(spark, sf_dir)
    path, stored = new_folder(spark, "by_region"), new_folder(spark, "checked")
    checked.select(ROW_ID, "region").write.parquet(stored)
    rows, written = spark.read.parquet(stored), []
    for region in ["UK-LONDON", "XX-NOWHERE", "NOT-A-REGION"]:
        own, folder = rows.where(F.col("region") == region), f"{path}/{region}"
        if layers.write_if_rows(own, lambda df, folder=folder: df.write.parquet(folder)):
            written.append(spark.read.schema(rows.schema).parquet(folder))
    found = written[0]
    for more in written[1:]:
        found = found.unionByName(more)
    return found


def input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks of a table before any work say: which columns it lacks, and whether it has rows."""
    raw, found = base.tickets_raw(spark, sf_dir), None

    def said(check: Callable[[], DataFrame]) -> str:
        try:
            check()
        except ValueError as error:
            return str(error)
        return ""

    cases = {
        "whole": raw, "documents": table(spark, sf_dir, "documents"), "no text": raw.drop("customer_text"),
        "no rows": raw.where(F.col(ROW_ID) < 0),
    }
    for name, df in cases.items():
        message = said(lambda df=df: validation.require_rows(validation.require_columns(df)))
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), F.lit(message).alias("message"), "row_count")
        found = row if found is None else found.unionByName(row)
    return found


SPACES = ["", " ", "\t", "\n", "\u00a0", "\u2003", "\u3000", "\x85", "\u2028", " \x1f "]


def stripped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document sources between Unicode blanks, and texts of such blanks alone."""
    spaces = F.element_at(F.array(*map(F.lit, SPACES)), (F.col("doc_id") % len(SPACES) + 1).cast("int"))
    inner = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("source"))
    text = F.concat(spaces, inner, spaces, spaces)
    return table(spark, sf_dir, "documents").select("doc_id", strip(text).alias("stripped"), is_blank(text).alias("blank"))


def missing_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that a reader takes as missing, and others next to them, through a CSV file."""
    path = new_folder(spark, "csv")
    values = [*NA_TOKENS, "na", " NA", "none", "0", "N/A "]
    value = F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))
    layers.write_csv(table(spark, sf_dir, "events").select("event_id", value.alias("value"), "event_type"), path)
    raw = spark.read.options(**layers._csv_options(False), ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    read = null_missing(raw.schema("event_id string, value string, event_type string").csv(path))
    return read.select(F.col("event_id").cast("bigint"), "value", "event_type")


def run_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", execution_id(F.col("ts")).alias("execution_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        upsert_newest, rerun_outcomes, stream_restarted, stream_current_tickets, quarantined_by_filter,
        model_scoring_resumed, lexicon_modified_sentiment, lenient_timestamps, ticket_ids_over_runs, source_order,
        metrics_json, load_metrics, conditional_sink, input_checks, stripped_texts, missing_tokens, run_labels,
    )
}

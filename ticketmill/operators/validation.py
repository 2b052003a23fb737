"""Ticket checks, the split into valid and quarantined rows, and their reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.fixed_values import (
    CREATED_BLANK,
    CREATED_FUTURE,
    CREATED_INVALID,
    DUPLICATE_KEY,
    DUPLICATE_REASON,
    EMAIL_BLANK,
    EMAIL_INVALID,
    REGION_BLANK,
    REGION_UNKNOWN,
    REQUIRED_COLUMNS,
    RESPONSE_EARLY,
    RESPONSE_INVALID,
    TEXT_BLANK,
    TIMESTAMP_FORMATS,
)
from ticketmill.functions.numeric import percentage
from ticketmill.functions.text import digest, is_blank, is_email
from ticketmill.functions.timestamps import ntz, parse_timestamp, within_clock
from ticketmill.operators.dedup import FILTER_BITS, keep_latest, mark_superseded, maybe_repeated, repeated_key_filter
from ticketmill.operators.lookup import flag_members
from ticketmill.operators.rules import FAILED_RULES, REASON, Rule, apply_rules
from ticketmill.schemas import EXECUTION_ID, ROW_ID

CREATED, RESPONDED = "_created", "_responded"
DUPLICATE_RULE = "duplicate"


def require_columns(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Fail, before anything runs, when a column is missing."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """Fail when there is nothing to read. Runs a one-row job."""
    if df.isEmpty():
        raise ValueError("Input dataset is empty.")
    return df


def ticket_rules(as_of: datetime | str | Column, known_region: Column) -> list[Rule]:
    """The rules of a raw ticket, in the order their messages are listed.

    Blank tests come behind what is known already: a parsed time or a known region is not blank.
    """
    email, created, text, region, responded = (F.col(name) for name in REQUIRED_COLUMNS)

    def rule(name: str, subject: str, failed: Column, message: str, value: Column | None = None) -> Rule:
        return Rule(name, subject, failed, F.lit(message) if value is None else F.concat(F.lit(message), value))

    return [
        rule("email_blank", "email", is_blank(email), EMAIL_BLANK),
        rule("email_format", "email", ~is_email(email), EMAIL_INVALID, email),
        rule("created_blank", "created", F.col(CREATED).isNull() & is_blank(created), CREATED_BLANK),
        rule("created_format", "created", F.col(CREATED).isNull(), CREATED_INVALID, created),
        rule("created_future", "created", F.col(CREATED) > ntz(as_of), CREATED_FUTURE),
        rule("text_blank", "text", is_blank(text), TEXT_BLANK),
        rule("region_blank", "region", ~known_region & is_blank(region), REGION_BLANK),
        rule("region_unknown", "region", ~known_region, REGION_UNKNOWN, region),
        rule(
            "response_format",
            "response",
            responded.isNotNull() & F.col(RESPONDED).isNull(),
            RESPONSE_INVALID,
            responded,
        ),
        rule("response_early", "response", F.col(RESPONDED) < F.col(CREATED), RESPONSE_EARLY),
    ]


def check_tickets(
    bronze: DataFrame,
    regions: DataFrame,
    as_of: datetime | str | Column,
    formats: Sequence[str] = TIMESTAMP_FORMATS,
    region_column: str = "region_name",
    more_rules: Sequence[Rule] = (),
) -> DataFrame:
    """Judge every row: adds the parsed times, `failure_reason` and `failed_rules`.

    A projection over one lookup of the region; no shuffle while the region table is small. Messages of
    `more_rules` on the raw columns follow those of the ticket rules.
    """
    times = {CREATED: "created_at", RESPONDED: "first_response_at"}
    parsed = require_columns(bronze).withColumns({new: parse_timestamp(F.col(raw), formats) for new, raw in times.items()})
    parsed = parsed.withColumns({new: within_clock(F.col(new)) for new in times})
    named = regions.where(~is_blank(F.col(region_column)))
    flagged = flag_members(parsed, "region", named, region_column, "_known_region")
    return apply_rules(flagged, [*ticket_rules(as_of, F.col("_known_region")), *more_rules]).drop("_known_region")


def passed() -> Column:
    return F.col(REASON) == ""


def _scope(df: DataFrame) -> list[str]:
    """Copies count as duplicates within one run, so the run id joins the key where there is one."""
    return [EXECUTION_ID] if EXECUTION_ID in df.columns else []


def typed_layout(df: DataFrame) -> DataFrame:
    """Validated layout: the raw time texts give way to the parsed times."""
    return df.withColumns({"created_at": F.col(CREATED), "first_response_at": F.col(RESPONDED)}).drop(
        CREATED, RESPONDED, REASON, FAILED_RULES
    )


def raw_layout(df: DataFrame) -> DataFrame:
    """Quarantine layout: raw texts plus the reason."""
    return df.drop(CREATED, RESPONDED)


def valid_tickets(checked: DataFrame) -> DataFrame:
    """Rows that pass every rule, newest copy per e-mail and text. One shuffle."""
    survivors = keep_latest(
        checked.where(passed()), _scope(checked) + DUPLICATE_KEY, newest=CREATED, tie=[ROW_ID]
    )
    return typed_layout(survivors)


def judge_tickets(checked: DataFrame) -> DataFrame:
    """Every row with its final reason: rule failures, 'Duplicate email and text', or ''."""
    marked = mark_superseded(
        checked, _scope(checked), DUPLICATE_KEY, newest=CREATED, row_id=ROW_ID, eligible=passed(), flag="_superseded"
    )
    return marked.withColumns(
        {
            REASON: F.when(F.col("_superseded"), DUPLICATE_REASON).otherwise(F.col(REASON)),
            FAILED_RULES: F.when(F.col("_superseded"), F.array(F.lit(DUPLICATE_RULE))).otherwise(F.col(FAILED_RULES)),
        }
    ).drop("_superseded")


def judge_tickets_by_filter(
    bronze: DataFrame,
    regions: DataFrame,
    as_of: datetime | str | Column,
    filter_bits: int = FILTER_BITS,
    more_rules: Sequence[Rule] = (),
) -> DataFrame:
    """The same as `judge_tickets` of the checked rows, for tables with few copies.

    A first pass over the two key columns builds a filter of the keys that occur more than once. Rows whose
    key it does not hold have their verdict from the rules alone and are never shuffled; the others meet their
    copies as in `judge_tickets`.
    """
    pages = repeated_key_filter(bronze, _scope(bronze), DUPLICATE_KEY, filter_bits)
    flagged = maybe_repeated(bronze, pages, _scope(bronze), DUPLICATE_KEY, "_maybe", filter_bits)
    alone = check_tickets(flagged.where(~F.col("_maybe")).drop("_maybe"), regions, as_of, more_rules=more_rules)
    several = check_tickets(flagged.where(F.col("_maybe")).drop("_maybe"), regions, as_of, more_rules=more_rules)
    return alone.unionByName(judge_tickets(several))


def split_judged(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(validated, quarantine) of a judged table; store the judged table first when both are written."""
    return typed_layout(judged.where(passed())), raw_layout(judged.where(~passed()))


def quarantined_tickets(checked: DataFrame) -> DataFrame:
    """Rows with a reason: rule failures and older copies, raw texts kept."""
    return split_judged(judge_tickets(checked))[1]


def _copies(checked: DataFrame, *keep: str) -> DataFrame:
    """Rows per (reason, key) with the key blank on failed rows.

    The counts of a whole run follow from these groups alone: every passing group is one valid
    row and its other members are duplicates, so no row has to meet its twin. Partial aggregation
    folds a hot key before the shuffle.
    """
    key = F.when(passed(), digest(*[F.col(name) for name in DUPLICATE_KEY]))
    return (
        checked.select(*_scope(checked), *keep, passed().alias("_passed"), key.alias("_key"))
        .groupBy(*_scope(checked), *keep, "_passed", "_key")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )


def validation_summary(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows read, failed, duplicate, valid and quarantined, with the pass rate in percent.

    By columns other than the run id, every row is judged first: a duplicate counts where its own row
    stands, and the copy that is kept where the newest one does.
    """
    if not set(by) <= set(_scope(checked)):
        return _summary_by_row(checked, by)
    is_passed, rows = F.col("_passed"), F.col("_rows")
    counts = _copies(checked).groupBy(*by).agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.when(~is_passed, rows)), F.lit(0)).alias("rows_failed"),
        F.coalesce(F.sum(F.when(is_passed, rows - 1)), F.lit(0)).alias("rows_duplicate"),
        F.count_if(is_passed).alias("rows_valid"),
    )
    return counts.withColumns(
        {
            "rows_quarantined": F.col("rows_failed") + F.col("rows_duplicate"),
            "validation_pass_rate": percentage(F.col("rows_valid"), F.col("rows_read")),
        }
    )


def _summary_by_row(checked: DataFrame, by: Sequence[str]) -> DataFrame:
    valid, duplicate = passed(), F.col(REASON) == DUPLICATE_REASON
    counts = judge_tickets(checked).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~valid & ~duplicate).alias("rows_failed"),
        F.count_if(duplicate).alias("rows_duplicate"),
        F.count_if(valid).alias("rows_valid"),
    )
    return counts.withColumns(
        {
            "rows_quarantined": F.col("rows_failed") + F.col("rows_duplicate"),
            "validation_pass_rate": percentage(F.col("rows_valid"), F.col("rows_read")),
        }
    )


def failure_reason_counts(checked: DataFrame) -> DataFrame:
    """How often each full reason occurs, duplicates included, most frequent first."""
    is_passed = F.col("_passed")
    return (
        _copies(checked, REASON)
        .groupBy(F.when(is_passed, DUPLICATE_REASON).otherwise(F.col(REASON)).alias(REASON))
        .agg(F.sum(F.col("_rows") - is_passed.cast("bigint")).alias("row_count"))
        .where(F.col("row_count") > 0)
        .orderBy(F.desc("row_count"), REASON)
    )


def failure_rule_counts(checked: DataFrame) -> DataFrame:
    """How often each single rule fails, most frequent first."""
    return (
        checked.select(F.explode(FAILED_RULES).alias("rule_name"))
        .groupBy("rule_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "rule_name")
    )


def summarize_judged(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counts of a stored judged table: one pass, no key needed."""
    valid = F.count_if(passed())
    total = F.count(F.lit(1))
    return judged.groupBy(*by).agg(
        total.alias("rows_read"),
        valid.alias("rows_valid"),
        F.count_if(~passed()).alias("rows_quarantined"),
        percentage(valid, total).alias("validation_pass_rate"),
    )

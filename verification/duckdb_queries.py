"""The registered queries as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from ticketmill.fixed_values import (
    CREATED_BLANK, CREATED_FUTURE, CREATED_INVALID, DUPLICATE_REASON, EMAIL_BLANK, EMAIL_INVALID, KEYWORD_RULES,
    PROMPT_AFTER_TEXT, PROMPT_BEFORE_TEXT, REASON_SEPARATOR, REGION_BLANK, REGION_UNKNOWN, RESPONSE_EARLY,
    RESPONSE_INVALID, TEXT_BLANK,
)
from verification.event_views import LEXICON, TEXTS

TEXT_LIST = "[" + ", ".join(f"'{text}'" for text in TEXTS) + "]"
TICKETS = f"""
source AS (
  SELECT *, CAST(floor(value) AS BIGINT) AS whole FROM events
),
tickets AS (
  SELECT event_id AS _row_id,
    CASE event_id % 50 WHEN 1 THEN NULL WHEN 2 THEN 'no-at-sign' WHEN 3 THEN '@example.org' WHEN 4 THEN '   '
      ELSE 'user' || user_id || '@mail.example.org' END AS email_address,
    CASE event_id % 60 WHEN 5 THEN NULL WHEN 6 THEN 'not-a-date'
      WHEN 7 THEN strftime(ts + INTERVAL 400 DAY, '%Y-%m-%d %H:%M:%S')
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created_at,
    CASE event_id % 70 WHEN 8 THEN NULL WHEN 9 THEN '   '
      ELSE ({TEXT_LIST})[(user_id + whole) % 5 + 1] || ' Ref ' || whole END AS customer_text,
    CASE event_id % 80 WHEN 10 THEN NULL WHEN 11 THEN 'XX-NOWHERE'
      ELSE (['CA-TORONTO', 'AU-SYDNEY', 'UK-LONDON', 'SG-CENTRAL', 'JP-TOKYO'])[event_id % 5 + 1] END AS region,
    CASE WHEN event_id % 5 = 0 THEN NULL
      WHEN event_id % 90 = 12 THEN strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S')
      WHEN event_id % 90 = 13 THEN 'later'
      ELSE strftime(ts + to_seconds(300 + (event_id * 7919) % 86100), '%Y-%m-%d %H:%M:%S') END AS first_response_at
  FROM source
)"""

CHECKED = (
    TICKETS
    + f""",
parsed AS (
  SELECT *, try_cast(created_at AS TIMESTAMP) AS created, try_cast(first_response_at AS TIMESTAMP) AS responded
  FROM tickets
),
found AS (
  SELECT *,
    CASE WHEN email_address IS NULL OR trim(email_address) = '' THEN 'email_blank'
      WHEN NOT regexp_matches(trim(email_address), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') THEN 'email_format' END AS f1,
    CASE WHEN created_at IS NULL OR trim(created_at) = '' THEN 'created_blank'
      WHEN created IS NULL THEN 'created_format'
      WHEN created > TIMESTAMP '2024-02-01 00:00:00' THEN 'created_future' END AS f2,
    CASE WHEN customer_text IS NULL OR trim(customer_text) = '' THEN 'text_blank' END AS f3,
    CASE WHEN region IS NULL OR trim(region) = '' THEN 'region_blank'
      WHEN region NOT IN ('CA-TORONTO', 'AU-SYDNEY', 'UK-LONDON', 'SG-CENTRAL', 'JP-TOKYO') THEN 'region_unknown' END AS f4,
    CASE WHEN first_response_at IS NOT NULL AND responded IS NULL THEN 'response_format'
      WHEN responded < created THEN 'response_early' END AS f5
  FROM parsed
),
checked AS (
  SELECT *,
    list_filter([f1, f2, f3, f4, f5], lambda f: f IS NOT NULL) AS failed_rules,
    concat_ws('{REASON_SEPARATOR}',
      CASE f1 WHEN 'email_blank' THEN '{EMAIL_BLANK}'
        WHEN 'email_format' THEN '{EMAIL_INVALID}' || email_address END,
      CASE f2 WHEN 'created_blank' THEN '{CREATED_BLANK}'
        WHEN 'created_format' THEN '{CREATED_INVALID}' || created_at
        WHEN 'created_future' THEN '{CREATED_FUTURE}' END,
      CASE f3 WHEN 'text_blank' THEN '{TEXT_BLANK}' END,
      CASE f4 WHEN 'region_blank' THEN '{REGION_BLANK}'
        WHEN 'region_unknown' THEN '{REGION_UNKNOWN}' || region END,
      CASE f5 WHEN 'response_format' THEN '{RESPONSE_INVALID}' || first_response_at
        WHEN 'response_early' THEN '{RESPONSE_EARLY}' END) AS failure_reason
  FROM found
),
judged AS (
  SELECT *, CASE WHEN failure_reason = '' AND row_number() OVER (
      PARTITION BY failure_reason = '', email_address, customer_text ORDER BY created DESC, _row_id) > 1
    THEN '{DUPLICATE_REASON}' ELSE failure_reason END AS reason
  FROM checked
),
valid AS (
  SELECT _row_id, email_address, created AS created_at, customer_text, region, responded AS first_response_at
  FROM judged WHERE reason = ''
),
quarantine AS (
  SELECT _row_id, email_address, created_at, customer_text, region, first_response_at, reason AS failure_reason
  FROM judged WHERE reason <> ''
)"""
)

CATEGORIES = "('Technical', 'Billing', 'Account', 'Feedback', 'How-To Question', 'General')"

def polarity(text: str, lexicon: dict[str, float]) -> str:
    """Mean polarity of the listed words of a text, with exact sums."""
    words = f"regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}'']+')"
    cases = " ".join(f"WHEN '{word}' THEN {score}" for word, score in lexicon.items())
    hits = f"list_filter(list_transform({words}, lambda w: CAST(CASE w {cases} END AS DECIMAL(9,6))), lambda s: s IS NOT NULL)"
    return (
        f"CAST(coalesce(round(CAST(CAST(list_sum({hits}) AS DOUBLE) / nullif(len({hits}), 0) AS DECIMAL(18,6)), 1), 0) AS DOUBLE)"
    )


def keywords(text: str, rules: list[tuple[str, list[str]]], default: str) -> str:
    branches = " ".join(
        f"WHEN {' OR '.join(f'contains(lower({text}), $${w}$$)' for w in words)} THEN '{name}'" for name, words in rules
    )
    return f"CASE {branches} ELSE '{default}' END"


TICKET_LEXICON = LEXICON
DOCUMENT_LEXICON = {"the": 0.1, "und": -0.1, "license": -0.5, "data": 0.3, "report": 0.2, "der": -0.2, "la": 0.4}
TICKET_RULES = KEYWORD_RULES
DOCUMENT_RULES = [
    ("Legal", ["license", "copyright", "warranty"]),
    ("Contact", ["@", "phone", "http"]),
    ("German", [" und ", " der ", " die "]),
]

REPLIED = (
    CHECKED
    + """,
replied AS (
  SELECT *, CASE _row_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'garbage' WHEN 2 THEN '2.5|Account' WHEN 3 THEN '0.4| Billing'
      WHEN 4 THEN 'nan|Billing' WHEN 5 THEN '0.3|Unknown'
      ELSE CAST(CAST((_row_id % 21 - 10) / 10.0 AS DECIMAL(3,1)) AS VARCHAR) || '|' ||
        (['Technical', 'Billing', 'Account', 'Feedback', 'How-To Question'])[_row_id % 5 + 1] END AS model_reply
  FROM valid
)"""
)


def parsed_reply(reply: str) -> tuple[str, str]:
    """(score, category) expressions of a reply column."""
    score = f"try_cast(split_part({reply}, '|', 1) AS DOUBLE)"
    readable = f"contains({reply}, '|') AND {score} IS NOT NULL"
    category = f"split_part({reply}, '|', 2)"
    return (
        f"CASE WHEN {reply} IS NULL THEN NULL WHEN {readable} AND {score} BETWEEN -1 AND 1 THEN {score} "
        f"ELSE CAST(0 AS DOUBLE) END",
        f"CASE WHEN {reply} IS NULL THEN NULL WHEN {readable} AND {category} IN {CATEGORIES} THEN {category} "
        f"ELSE 'General' END",
    )


def silver(source: str, reply: str) -> str:
    score, category = parsed_reply(reply)
    return f"""
  SELECT * EXCLUDE ({reply}),
    coalesce({score}, {polarity("customer_text", TICKET_LEXICON)}) AS sentiment_score,
    coalesce({category}, {keywords("customer_text", TICKET_RULES, "Feedback")}) AS category,
    CASE WHEN {reply} IS NULL THEN 'textblob' ELSE 'gemini' END AS analysis_source
  FROM {source}"""


SILVER = REPLIED + f",\nsilver AS ({silver('replied', 'model_reply')})"

TO_GOLD = """,
dim_regions(region_id, region_name) AS (
  VALUES (1, 'CA-TORONTO'), (2, 'AU-SYDNEY'), (3, 'UK-LONDON'), (4, 'SG-CENTRAL'), (5, 'JP-TOKYO')),
dim_categories(category_id, category_name) AS (
  VALUES (1, 'Technical'), (2, 'Billing'), (3, 'Account'), (4, 'Feedback'), (5, 'How-To Question'), (6, 'General')),
fact AS (
  SELECT email_address, created_at, customer_text, first_response_at, sentiment_score, analysis_source,
    region_id, category_id, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_date
  FROM silver LEFT JOIN dim_regions ON region = region_name LEFT JOIN dim_categories ON category = category_name
),
gold AS (
  SELECT fact.*,
    CAST(round(CAST(date_sub('minute', created_at, first_response_at) / 60 AS DECIMAL(18,6)), 2) AS DOUBLE)
      AS response_latency_hrs,
    CASE WHEN sentiment_score <= -0.6 THEN 'P1-URGENT' WHEN sentiment_score < 0 THEN 'P2-HIGH'
      WHEN sentiment_score >= 0.5 THEN 'P4-LOW' ELSE 'P3-NORMAL' END AS severity,
    region_name AS region, category_name AS category
  FROM fact LEFT JOIN dim_regions USING (region_id) LEFT JOIN dim_categories USING (category_id)
)"""

GOLD = SILVER + TO_GOLD

RUNS = """
log AS (
  SELECT event_id AS run_id, CAST(event_id // 5 AS VARCHAR) AS execution_id,
    CAST(CASE WHEN event_id % 5 = 4 THEN 4 ELSE event_id % 5 + 1 END AS BIGINT) AS stage_id,
    CASE WHEN event_id % 97 = 0 THEN 'STARTED' WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'FAILED'
      ELSE 'SUCCESS' END AS run_status,
    ts AS run_start_time, ts + to_milliseconds(CAST(floor(value * 1000) AS BIGINT)) AS end_time,
    event_id % 50 + 100 AS n, event_id AS i, props
  FROM events
),
runs AS (
  SELECT run_id, execution_id, stage_id, run_status, run_start_time,
    CASE WHEN run_status <> 'STARTED' THEN end_time END AS run_end_time,
    CASE WHEN run_status <> 'STARTED' THEN CAST(date_diff('second', run_start_time, end_time) AS DOUBLE) END
      AS duration_seconds,
    CASE WHEN run_status = 'SUCCESS' THEN CASE i % 5
      WHEN 0 THEN '{"rows_generated": ' || n || '}'
      WHEN 1 THEN '{"rows_read": ' || n || ', "rows_valid": ' || (n - i % 7) || ', "rows_quarantined": ' || (i % 7) || '}'
      WHEN 2 THEN '{"rows_read": ' || n || ', "rows_enriched": ' || n || ', "gemini_enrichments": ' || (n - i % 9)
        || ', "textblob_enrichments": ' || (i % 9) || '}'
      ELSE '{"rows_loaded": ' || n || '}' END END AS metrics,
    CASE WHEN run_status = 'FAILED' THEN 'stage failed at ' || props END AS error_message
  FROM log
)"""


def percent(part: str, total: str) -> str:
    return f"CAST(round(CAST({part} * 100.0::DOUBLE / nullif({total}, 0) AS DECIMAL(18,6)), 1) AS DOUBLE)"


def rounded(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(18,6)), {places}) AS DOUBLE)"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def metric(name: str) -> str:
    return f"CAST(json_extract(metrics, '$.{name}') AS BIGINT)"


def sla(by: str) -> str:
    met = "count(*) FILTER (WHERE first_response_at IS NOT NULL AND response_latency_hrs <= target)"
    answered = "count(*) FILTER (WHERE first_response_at IS NOT NULL AND target IS NOT NULL)"
    return f"""
SELECT {by}, count(*) AS total_tickets, {met} AS met_target,
  count(*) FILTER (WHERE first_response_at IS NOT NULL AND response_latency_hrs > target) AS missed_target,
  count(*) FILTER (WHERE first_response_at IS NULL) AS unanswered,
  {percent(met, answered)} AS met_percentage
FROM (SELECT *, CASE severity WHEN 'P1-URGENT' THEN 4.0 WHEN 'P2-HIGH' THEN 8.0 WHEN 'P3-NORMAL' THEN 12.5 END AS target
      FROM gold)
GROUP BY {by}"""


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


# Copies count within a run only: the run joins the key of the ranking.
IN_RUNS = "run_of AS (SELECT event_id AS _row_id, CAST(event_id // 500 AS VARCHAR) AS execution_id FROM events),\n" + (
    CHECKED.replace("PARTITION BY failure_reason = ''", "PARTITION BY _row_id // 500, failure_reason = ''")
)
VALID_COLUMNS = "_row_id, email_address, created_at, customer_text, region, first_response_at"
RUN_OF_FACT = "'2024' || strftime(created_at, '%m') || '_' || region_id"

SCORED = (
    CHECKED
    + """,
measured AS (SELECT *, length(customer_text) + 309 AS n FROM valid),
scored AS (
  SELECT * EXCLUDE (n), CASE WHEN n % 4 = 0 THEN NULL ELSE CAST(CAST((n % 21 - 10) / 10.0 AS DECIMAL(3,1)) AS VARCHAR) || '|' ||
    (['Technical', 'Billing', 'Account', 'Feedback', 'How-To Question'])[n % 5 + 1] END AS model_reply FROM measured)"""
)
SEVERITY_REPORT = f"""SELECT severity, count(*) AS ticket_count, count(first_response_at) AS responded_tickets,
  count(*) - count(first_response_at) AS unanswered_tickets,
  {rounded("avg(CAST(response_latency_hrs AS DECIMAL(18,2)))", 2)} AS avg_latency_hrs FROM gold GROUP BY 1"""

HOURLY_STREAM = """SELECT strftime(date_trunc('hour', created), '%Y-%m-%d %H:%M') AS created_date,
  count(*) AS ticket_count FROM checked WHERE created IS NOT NULL GROUP BY 1"""

ORACLES: dict[str, str] = {
    "tickets_raw": with_ctes(TICKETS, "SELECT * FROM tickets"),
    "validate_reasons": with_ctes(CHECKED, "SELECT _row_id, failure_reason FROM checked"),
    "valid_tickets": with_ctes(CHECKED, f"SELECT {VALID_COLUMNS} FROM valid"),
    "quarantined_tickets": with_ctes(CHECKED, "SELECT * FROM quarantine"),
    "judged_by_outcome": with_ctes(
        CHECKED, "SELECT _row_id, reason = '' AS is_valid, reason AS failure_reason FROM judged"
    ),
    "judged_with_hot_key": with_ctes(
        CHECKED.replace(
            "SELECT *, try_cast(created_at",
            """SELECT * REPLACE (CASE WHEN _row_id % 3 = 0 THEN 'hot@example.org' ELSE email_address END AS email_address,
    CASE WHEN _row_id % 3 = 0 THEN 'Everyone sends this' ELSE customer_text END AS customer_text), try_cast(created_at""",
        ),
        "SELECT _row_id, reason AS failure_reason FROM judged",
    ),
    "valid_tickets_in_runs": with_ctes(
        IN_RUNS, f"SELECT {VALID_COLUMNS}, execution_id FROM valid JOIN run_of USING (_row_id)"
    ),
    "validation_summary_by_run": with_ctes(
        IN_RUNS,
        f"""SELECT execution_id, count(*) AS rows_read, count(*) FILTER (WHERE failure_reason <> '') AS rows_failed,
  count(*) FILTER (WHERE failure_reason = '' AND reason <> '') AS rows_duplicate,
  count(*) FILTER (WHERE reason = '') AS rows_valid, count(*) FILTER (WHERE reason <> '') AS rows_quarantined,
  {percent("count(*) FILTER (WHERE reason = '')", "count(*)")} AS validation_pass_rate
FROM judged JOIN run_of USING (_row_id) GROUP BY execution_id""",
    ),
    "failure_reason_counts": with_ctes(
        CHECKED, "SELECT failure_reason, count(*) AS row_count FROM quarantine GROUP BY 1"
    ),
    "failure_rule_counts": with_ctes(
        CHECKED,
        "SELECT rule_name, count(*) AS row_count FROM (SELECT unnest(failed_rules) AS rule_name FROM checked) GROUP BY 1",
    ),
    "validation_summary": with_ctes(
        CHECKED,
        f"""SELECT count(*) AS rows_read, count(*) FILTER (WHERE failure_reason <> '') AS rows_failed,
  count(*) FILTER (WHERE failure_reason = '' AND reason <> '') AS rows_duplicate,
  count(*) FILTER (WHERE reason = '') AS rows_valid, count(*) FILTER (WHERE reason <> '') AS rows_quarantined,
  {percent("count(*) FILTER (WHERE reason = '')", "count(*)")} AS validation_pass_rate FROM judged""",
    ),
    "not_null_check": with_ctes(
        TICKETS,
        """SELECT * FROM (SELECT _row_id, concat_ws('; ',
    CASE WHEN email_address IS NULL THEN 'email_address is NULL' END,
    CASE WHEN created_at IS NULL THEN 'created_at is NULL' END,
    CASE WHEN customer_text IS NULL THEN 'customer_text is NULL' END,
    CASE WHEN region IS NULL THEN 'region is NULL' END) AS failure_reason FROM tickets) WHERE failure_reason <> ''""",
    ),
    "max_length_check": """SELECT * FROM (SELECT doc_id, concat_ws('; ',
    CASE WHEN strlen(text) > 1000 THEN 'text is longer than 1000' END,
    CASE WHEN strlen(lang) > 2 THEN 'lang is longer than 2' END) AS failure_reason FROM documents)
WHERE failure_reason <> ''""",
    "in_set_check": """SELECT event_id, 'run_status not allowed: ' || event_type AS failure_reason FROM events
WHERE event_type NOT IN ('error', 'view', 'click')""",
    "fact_check": """SELECT * FROM (SELECT doc_id, concat_ws('; ',
    CASE WHEN doc_id % 17 = 0 THEN 'email_address is NULL'
      WHEN strlen(source || '@x.org') > 100 THEN 'email_address is longer than 100' END,
    CASE WHEN strlen(text) > 1000 THEN 'customer_text is longer than 1000' END,
    CASE WHEN doc_id % 13 = 0 THEN 'sentiment_score is NULL' END,
    CASE WHEN strlen(lang) * (20 + doc_id % 10) > 50 THEN 'analysis_source is longer than 50' END) AS failure_reason
  FROM documents) WHERE failure_reason <> ''""",
    "run_log_check": with_ctes(
        RUNS,
        """SELECT * FROM (SELECT run_id, concat_ws('; ',
    CASE WHEN run_id % 50 = 0 THEN 'stage_id is NULL' END,
    CASE WHEN run_id % 30 = 0 THEN 'run_status not allowed: LOST' END) AS failure_reason
  FROM (SELECT run_id FROM runs UNION ALL SELECT run_id FROM runs WHERE run_status <> 'STARTED'))
WHERE failure_reason <> ''""",
    ),
    "unique_check": with_ctes(
        TICKETS,
        """SELECT email_address, customer_text, count(*) AS row_count FROM tickets
WHERE email_address IS NOT NULL AND customer_text IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
    ),
    "unique_check_lineitem": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""",
    "referential_check": """SELECT doc_id, lang, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "referential_check_events": """SELECT event_id, user_id FROM events
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)""",
    "reference_scan": """SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1""",
    "parse_model_reply": with_ctes(
        REPLIED,
        f"""SELECT _row_id, model_reply, {parsed_reply("model_reply")[0]} AS model_score,
  {parsed_reply("model_reply")[1]} AS model_category FROM replied""",
    ),
    "keyword_category": with_ctes(
        TICKETS,
        f"""SELECT _row_id, {keywords("customer_text", TICKET_RULES, "Feedback")} AS category FROM tickets""",
    ),
    "keyword_category_documents": f"SELECT doc_id, {keywords('text', DOCUMENT_RULES, 'Other')} AS category FROM documents",
    "lexicon_sentiment": with_ctes(
        CHECKED, f"SELECT _row_id, {polarity('customer_text', TICKET_LEXICON)} AS sentiment_score FROM valid"
    ),
    "lexicon_sentiment_documents": f"SELECT doc_id, {polarity('text', DOCUMENT_LEXICON)} AS sentiment_score FROM documents",
    "lexicon_table_sentiment": """WITH lexicon AS (
  SELECT DISTINCT word, CAST((length(word) % 21 - 10) / 10.0 AS DECIMAL(9,6)) AS polarity
  FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}'']+')) AS word FROM benchmark) WHERE word <> ''),
scores AS (
  SELECT doc_id, CAST(round(CAST(CAST(sum(polarity) AS DOUBLE) / count(*) AS DECIMAL(18,6)), 1) AS DOUBLE) AS score
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}'']+')) AS word FROM documents)
  JOIN lexicon USING (word) GROUP BY 1)
SELECT doc_id, coalesce(score, 0) AS sentiment_score FROM documents LEFT JOIN scores USING (doc_id)""",
    "enriched_tickets": with_ctes(SILVER, "SELECT * FROM silver"),
    "enrichment_summary": with_ctes(
        SILVER,
        f"""SELECT count(*) AS rows_read, count(*) AS rows_enriched,
  count(*) FILTER (WHERE analysis_source = 'gemini') AS gemini_enrichments,
  count(*) FILTER (WHERE analysis_source = 'textblob') AS textblob_enrichments,
  {percent("count(*) FILTER (WHERE analysis_source = 'gemini')", "count(*)")} AS gemini_percentage FROM silver""",
    ),
    "model_scoring_batch": with_ctes(
        SCORED,
        f"SELECT _row_id, sentiment_score, category, analysis_source FROM ({silver('scored', 'model_reply')})",
    ),
    "prompt_text": with_ctes(
        CHECKED,
        f"""SELECT _row_id, '{PROMPT_BEFORE_TEXT}' || customer_text || '{PROMPT_AFTER_TEXT}' AS prompt FROM valid""",
    ),
    "fact_rows": with_ctes(GOLD, "SELECT * FROM fact"),
    "gold_tickets": with_ctes(GOLD, "SELECT * FROM gold"),
    "generated_keys": with_ctes(
        CHECKED,
        """SELECT count(*) AS row_count, count(DISTINCT (email_address, customer_text)) AS content_keys,
  0::BIGINT AS too_small FROM valid""",
    ),
    "severity_report": with_ctes(GOLD, SEVERITY_REPORT),
    "category_sentiment": with_ctes(
        GOLD,
        f"""SELECT category, {rounded("avg(CAST(sentiment_score AS DECIMAL(18,6)))", 2)} AS avg_sentiment_score,
  count(*) AS volume FROM gold GROUP BY 1""",
    ),
    "region_escalation": with_ctes(
        GOLD,
        """SELECT region, count(*) FILTER (WHERE severity = 'P1-URGENT' AND first_response_at IS NULL) AS critical_count,
  count(*) FILTER (WHERE severity = 'P2-HIGH' AND first_response_at IS NULL) AS high_risk_count,
  count(*) AS total_tickets FROM gold GROUP BY 1""",
    ),
    "open_vs_responded": with_ctes(
        GOLD,
        """SELECT CASE WHEN first_response_at IS NULL THEN 'Open' ELSE 'Responded' END AS ticket_status,
  count(*) AS total_tickets FROM gold GROUP BY 1""",
    ),
    "source_counts": with_ctes(GOLD, "SELECT analysis_source, count(*) AS total_records FROM gold GROUP BY 1"),
    "hourly_trend": with_ctes(
        GOLD,
        "SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M') AS created_date, count(*) AS ticket_count "
        "FROM gold GROUP BY 1",
    ),
    "sla_by_severity": with_ctes(GOLD, sla("severity")),
    "sla_by_region": with_ctes(GOLD, sla("region, severity")),
    "config_values": """SELECT max(s_name) FILTER (WHERE s_suppkey = 1) AS supplier_1,
  max(s_name) FILTER (WHERE s_suppkey = 7) AS supplier_7, CAST(NULL AS VARCHAR) AS not_a_key FROM supplier""",
    "stage_lookup": with_ctes(
        RUNS,
        """SELECT 'AI_SUPPORT' AS pipeline_code, CAST(stage_id AS INTEGER) AS stage_order,
  CASE stage_id WHEN 1 THEN 'Generate Raw Data' WHEN 2 THEN 'Validate Bronze Data' WHEN 3 THEN 'AI Enrichment'
    ELSE 'Load to Lakehouse' END AS stage_name, count(*) AS run_count FROM runs GROUP BY 1, 2, 3""",
    ),
    "run_state": with_ctes(RUNS, "SELECT * FROM runs"),
    "latest_attempt": with_ctes(
        RUNS,
        """SELECT execution_id, stage_id, max(run_id) AS run_id, arg_max(run_status, run_id) AS run_status
FROM runs GROUP BY 1, 2""",
    ),
    "run_health": with_ctes(
        RUNS,
        f"""SELECT stage_id, count(*) AS total_runs,
  count(*) FILTER (WHERE run_status = 'STARTED') AS started_runs,
  count(*) FILTER (WHERE run_status = 'SUCCESS') AS success_runs,
  count(*) FILTER (WHERE run_status = 'FAILED') AS failed_runs,
  count(*) FILTER (WHERE run_status = 'SKIPPED') AS skipped_runs,
  {percent("count(*) FILTER (WHERE run_status = 'SUCCESS')", "count(*)")} AS success_rate FROM runs GROUP BY 1""",
    ),
    "stage_performance": with_ctes(
        RUNS,
        f"""SELECT stage_id, count(*) AS ended_runs, sum(duration_seconds) AS total_seconds,
  {rounded("sum(duration_seconds) / count(*)", 2)} AS avg_seconds, min(duration_seconds) AS min_seconds,
  max(duration_seconds) AS max_seconds, quantile_cont(duration_seconds, 0.5) AS median_seconds,
  {rounded("quantile_cont(duration_seconds, 0.95)", 2)} AS p95_seconds
FROM runs WHERE duration_seconds IS NOT NULL GROUP BY 1""",
    ),
    "validation_over_runs": with_ctes(
        RUNS,
        f"""SELECT strftime(run_start_time, '%Y-%m-%d') AS run_date, count(*) AS run_count,
  {big(f"sum({metric('rows_read')})")} AS rows_read, {big(f"sum({metric('rows_valid')})")} AS rows_valid,
  {big(f"sum({metric('rows_quarantined')})")} AS rows_quarantined,
  {percent(f"sum({metric('rows_valid')})", f"sum({metric('rows_read')})")} AS validation_pass_rate
FROM runs WHERE stage_id = 2 AND run_status = 'SUCCESS' GROUP BY 1""",
    ),
    "ai_usage_over_runs": with_ctes(
        RUNS,
        f"""SELECT strftime(run_start_time, '%Y-%m-%d') AS run_date, count(*) AS run_count,
  {big(f"sum({metric('rows_read')})")} AS rows_read, {big(f"sum({metric('rows_enriched')})")} AS rows_enriched,
  {big(f"sum({metric('gemini_enrichments')})")} AS gemini_enrichments,
  {big(f"sum({metric('textblob_enrichments')})")} AS textblob_enrichments,
  {percent(f"sum({metric('gemini_enrichments')})", f"sum({metric('rows_read')})")} AS gemini_percentage
FROM runs WHERE stage_id = 3 AND run_status = 'SUCCESS' GROUP BY 1""",
    ),
    "runtime_trend": with_ctes(
        RUNS,
        """SELECT strftime(run_start_time, '%Y-%m-%d') AS run_date, stage_id, count(*) AS run_count,
  sum(duration_seconds) AS total_seconds FROM runs GROUP BY 1, 2""",
    ),
    "failed_runs": with_ctes(
        RUNS,
        """SELECT run_id, execution_id, stage_id, run_start_time, run_end_time, duration_seconds, error_message
FROM runs WHERE run_status = 'FAILED'""",
    ),
    "run_lineage": with_ctes(
        RUNS,
        """SELECT execution_id, count(*) AS attempts,
  arg_max(run_status, run_id) FILTER (WHERE stage_id = 1) AS generate_raw_data,
  arg_max(run_status, run_id) FILTER (WHERE stage_id = 2) AS validate_bronze_data,
  arg_max(run_status, run_id) FILTER (WHERE stage_id = 3) AS ai_enrichment,
  arg_max(run_status, run_id) FILTER (WHERE stage_id = 4) AS load_to_lakehouse FROM runs GROUP BY 1""",
    ),
    "csv_round_trip": with_ctes(
        TICKETS, "SELECT t.*, d.text AS extra FROM tickets t LEFT JOIN documents d ON t._row_id = d.doc_id"
    ),
    "partition_overwrite_rerun": with_ctes(
        GOLD,
        f"""SELECT * REPLACE (CASE WHEN execution_id = '202401_2' THEN 1.0 ELSE sentiment_score END AS sentiment_score)
FROM (SELECT *, {RUN_OF_FACT} AS execution_id FROM fact) WHERE execution_id <> '202401_3'""",
    ),
    "insert_only_merge": with_ctes(
        GOLD,
        f"""SELECT * REPLACE (CASE WHEN region_id <= 2 THEN 0.0 ELSE sentiment_score END AS sentiment_score),
  {RUN_OF_FACT} AS execution_id FROM fact""",
    ),
    "append_known_keys": """SELECT o_orderkey, o_custkey, c_mktsegment
FROM orders CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) segments
WHERE NOT EXISTS (SELECT 1 FROM customer c
  WHERE c.c_custkey IS NOT DISTINCT FROM o_custkey AND c.c_mktsegment IS NOT DISTINCT FROM segments.c_mktsegment)""",
    "run_from_raw_to_gold": with_ctes(
        SCORED + f",\nsilver AS ({silver('scored', 'model_reply')})" + TO_GOLD, SEVERITY_REPORT
    ),
    "stream_hourly_trend": with_ctes(CHECKED, HOURLY_STREAM),
    "stream_hourly_counts": with_ctes(CHECKED, HOURLY_STREAM),
    "stream_ingest_valid": with_ctes(CHECKED, f"SELECT {VALID_COLUMNS} FROM valid"),
    "stream_ingest_quarantine": with_ctes(CHECKED, "SELECT * FROM quarantine"),
    "stream_first_copies": with_ctes(
        CHECKED, "SELECT DISTINCT email_address, customer_text FROM checked WHERE created IS NOT NULL"
    ),
    "stream_dedup_latest": with_ctes(CHECKED, f"SELECT {VALID_COLUMNS} FROM valid"),
}

"""The queries of `stored_queries` as DuckDB SQL."""

from __future__ import annotations

from ticketmill.fixed_values import NA_TOKENS, WHITESPACE
from verification.duckdb_queries import (
    CHECKED, DOCUMENT_LEXICON, GOLD, ORACLES as BASE, SCORED, TICKETS, VALID_COLUMNS, silver, with_ctes,
)

STRENGTH = {"and": 1.5, "in": 1.2, "the": 0.8}
NEGATIONS = ["of", "von"]
SPACES = ["", " ", "\t", "\n", "\u00a0", "\u2003", "\u3000", "\x85", "\u2028", " \x1f "]


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


POLARITIES = " ".join(f"WHEN {quoted(w)} THEN {p}" for w, p in DOCUMENT_LEXICON.items())
FACTORS = " ".join(f"WHEN {quoted(w)} THEN {f}" for w, f in STRENGTH.items())
MISSING = [*NA_TOKENS, "na", " NA", "none", "0", "N/A "]

ORACLES: dict[str, str] = {
    "upsert_newest": with_ctes(
        GOLD,
        """SELECT * EXCLUDE (ingestion_date) REPLACE (0.0 AS sentiment_score), 1 AS version FROM fact
UNION ALL
SELECT * EXCLUDE (ingestion_date) REPLACE (
    CASE WHEN region_id >= 3 THEN sentiment_score WHEN region_id = 2 THEN -1.0 ELSE 0.0 END AS sentiment_score,
    CASE WHEN region_id >= 3 THEN created_at + INTERVAL 1 HOUR ELSE created_at END AS created_at), 4 AS version FROM fact""",
    ),
    "rerun_outcomes": with_ctes(
        CHECKED,
        """SELECT 'r1' AS execution_id, _row_id, 'valid' AS outcome FROM valid
UNION ALL SELECT 'r2', _row_id, 'quarantined' FROM tickets WHERE region IS NULL OR region = 'XX-NOWHERE'""",
    ),
    "stream_restarted": with_ctes(TICKETS, "SELECT * FROM tickets"),
    "stream_current_tickets": with_ctes(CHECKED, f"SELECT {VALID_COLUMNS} FROM valid"),
    "quarantined_by_filter": BASE["quarantined_tickets"],
    "model_scoring_resumed": with_ctes(SCORED, "SELECT _row_id, model_reply FROM scored"),
    "lexicon_modified_sentiment": f"""WITH texts AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}'']+') AS w FROM documents),
words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
found AS (
  SELECT doc_id, CAST(CASE w[i] {POLARITIES} END AS DECIMAL(13,6)) AS polarity, w[greatest(i - 3, 1):i - 1] AS before
  FROM words),
weighed AS (
  SELECT doc_id, polarity, CAST(
      CASE WHEN len(list_filter(before, lambda b: b IN {tuple(NEGATIONS)})) > 0 THEN -0.5 ELSE 1.0 END
      * coalesce(CASE list_filter(before, lambda b: b IN {tuple(STRENGTH)})[-1] {FACTORS} END, 1.0) AS DECIMAL(9,4)) AS factor
  FROM found WHERE polarity IS NOT NULL),
scores AS (
  SELECT doc_id, CAST(round(CAST(CAST(sum(CAST(polarity * factor AS DECIMAL(13,6))) AS DOUBLE) / count(*) AS DECIMAL(18,6)), 1) AS DOUBLE) AS score
  FROM weighed GROUP BY 1)
SELECT doc_id, coalesce(score, 0) AS inline_score, coalesce(score, 0) AS table_score
FROM documents LEFT JOIN scores USING (doc_id)""",
    "lenient_timestamps": """SELECT event_id, CASE
    WHEN k IN (0, 1, 2) THEN date_trunc('minute', ts)
    WHEN k = 3 THEN date_trunc('second', ts) + INTERVAL 123 MILLISECOND
    WHEN k = 4 THEN date_trunc('second', ts) + INTERVAL 500 MILLISECOND
    WHEN k IN (5, 9, 11) THEN date_trunc('second', ts)
    WHEN k = 8 THEN date_trunc('month', ts)
    ELSE date_trunc('day', ts) END::TIMESTAMP AS parsed
FROM (SELECT *, event_id % 12 AS k FROM events)""",
    "ticket_ids_over_runs": with_ctes(
        CHECKED,
        """SELECT * FROM (
  WITH n AS (SELECT count(*) FILTER (WHERE _row_id % 3 = 0) AS n0, count(*) FILTER (WHERE _row_id % 3 = 1) AS n1,
      count(*) FILTER (WHERE _row_id % 3 = 2) AS n2 FROM valid),
  runs(execution_id, row_count, before) AS (
    SELECT 'r0', n0, 0 FROM n UNION ALL SELECT 'unlogged', n0, 1000000 FROM n
    UNION ALL SELECT 'r1', n1, 1000000 + n0 + n1 + n2 FROM n UNION ALL SELECT 'r2', n2, 1000000 + n0 + n1 FROM n)
  SELECT execution_id, row_count, row_count AS ids, (before + 1)::BIGINT AS first_id, (before + row_count)::BIGINT AS last_id
  FROM runs)""",
    ),
    "source_order": "SELECT event_id, row_number() OVER (ORDER BY event_id) AS _row_id FROM events",
    "metrics_json": f"SELECT *, NULL::BIGINT AS not_measured FROM ({BASE['validation_summary_by_run']})",
    "load_metrics": with_ctes(
        SCORED + f",\nsilver AS ({silver('scored', 'model_reply')})",
        """SELECT stage_id::BIGINT AS stage_id, max(v) FILTER (WHERE k = 'rows_generated') AS rows_generated,
  max(v) FILTER (WHERE k = 'rows_read') AS rows_read, max(v) FILTER (WHERE k = 'rows_valid') AS rows_valid,
  max(v) FILTER (WHERE k = 'rows_quarantined') AS rows_quarantined, max(v) FILTER (WHERE k = 'rows_enriched') AS rows_enriched,
  max(v) FILTER (WHERE k = 'gemini_enrichments') AS gemini_enrichments, max(v) FILTER (WHERE k = 'rows_loaded') AS rows_loaded,
  max(v) FILTER (WHERE k = 'last_ticket_id') AS last_ticket_id
FROM (
  SELECT 1 AS stage_id, 'rows_generated' AS k, count(*) AS v FROM tickets
  UNION ALL SELECT 2, 'rows_read', count(*) FROM tickets
  UNION ALL SELECT 2, 'rows_valid', count(*) FROM valid
  UNION ALL SELECT 2, 'rows_quarantined', count(*) FROM quarantine
  UNION ALL SELECT 3, 'rows_read', count(*) FROM valid
  UNION ALL SELECT 3, 'rows_enriched', count(*) FROM valid
  UNION ALL SELECT 3, 'gemini_enrichments', count(*) FROM silver WHERE analysis_source = 'gemini'
  UNION ALL SELECT 4, 'rows_loaded', count(*) FROM valid
  UNION ALL SELECT 4, 'last_ticket_id', count(*) FROM valid) GROUP BY stage_id""",
    ),
    "conditional_sink": with_ctes(TICKETS, "SELECT _row_id, region FROM tickets WHERE region IN ('UK-LONDON', 'XX-NOWHERE')"),
    "input_checks": """SELECT 'whole' AS name, '' AS message, count(*) AS row_count FROM events
UNION ALL SELECT 'documents', 'Missing required columns: [''email_address'', ''created_at'', ''customer_text'', ''region'', ''first_response_at'']',
  count(*) FROM documents
UNION ALL SELECT 'no text', 'Missing required columns: [''customer_text'']', count(*) FROM events
UNION ALL SELECT 'no rows', 'Input dataset is empty.', 0""",
    "stripped_texts": f"""SELECT doc_id, trim(text, {quoted(WHITESPACE)}) AS stripped, trim(text, {quoted(WHITESPACE)}) = '' OR text IS NULL AS blank
FROM (SELECT doc_id, blanks || CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END || blanks || blanks AS text
  FROM (SELECT *, ({listed(SPACES)})[doc_id % {len(SPACES)} + 1] AS blanks FROM documents))""",
    "missing_tokens": f"""SELECT event_id, CASE WHEN list_contains({listed(NA_TOKENS)}, value) THEN NULL ELSE value END AS value, event_type
FROM (SELECT event_id, ({listed(MISSING)})[event_id % {len(MISSING)} + 1] AS value, event_type FROM events)""",
    "run_labels": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS execution_id FROM events",
}

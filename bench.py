"""Wall seconds of the headline queries, printed as one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores. Every query runs
to the end over its whole tables and its rows go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticketmill.plans.session import local_session  # noqa: E402
from verification.queries import QUERIES  # noqa: E402

HEADLINE = [
    "validate_reasons",
    "valid_tickets",
    "quarantined_tickets",
    "validation_summary",
    "failure_reason_counts",
    "unique_check_lineitem",
    "keyword_category_documents",
    "lexicon_sentiment_documents",
    "lexicon_table_sentiment",
    "enriched_tickets",
    "model_scoring_batch",
    "gold_tickets",
    "severity_report",
    "category_sentiment",
    "region_escalation",
    "open_vs_responded",
    "source_counts",
    "hourly_trend",
    "sla_by_region",
    "run_state",
    "run_health",
    "stage_performance",
    "run_lineage",
    "run_from_raw_to_gold",
    "csv_round_trip",
    "partition_overwrite_rerun",
    "stream_ingest_valid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "wall seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

"""All registered queries and their SQL."""

from __future__ import annotations

from verification import duckdb_queries, spark_queries, stored_oracles, stored_queries

QUERIES = {**spark_queries.QUERIES, **stored_queries.QUERIES}
ORACLES = {**duckdb_queries.ORACLES, **stored_oracles.ORACLES}

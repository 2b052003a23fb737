"""Queries that take in all rows of their tables, on rows of their own."""

from __future__ import annotations

from verification.compare import connect, duckdb_rows, spark_rows
from verification.queries import ORACLES, QUERIES


def test_append_known_keys_takes_the_customers_of_all_segments_under_their_own_keys(spark, tmp_path):
    customers = [(1, "BUILDING"), (2, "HOUSEHOLD"), (2, "HOUSEHOLD"), (4, None)]
    orders = [(10, 1), (20, 2), (30, 3), (40, 4), (50, None), (60, 2)]
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    known = set(customers)
    expected = {(o, c, s) for o, c in orders for s in ("BUILDING", "HOUSEHOLD", None) if (c, s) not in known}
    found = [tuple(r) for r in QUERIES["append_known_keys"](spark, str(tmp_path)).collect()]
    assert set(found) == expected and len(found) == len(expected)


def test_append_known_keys_holds_the_orders_it_gave_before(spark):
    """Two segments were judged at first; what neither of them knows is among the rows of all segments."""
    tables = "/root/testdata/sf0.001"
    duck = connect(tables)
    rows = QUERIES["append_known_keys"](spark, tables)
    assert spark_rows(rows) == duckdb_rows(duck, ORACLES["append_known_keys"])
    two = rows.where("c_mktsegment IN ('BUILDING', 'AUTOMOBILE')").groupBy("o_orderkey", "o_custkey").count().where("count = 2")
    first = """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (
  SELECT c_custkey FROM customer WHERE contains(c_mktsegment, 'BUILD') OR contains(c_mktsegment, 'AUTO'))"""
    assert spark_rows(two.drop("count")) == duckdb_rows(duck, first)

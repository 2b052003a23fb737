"""Landed rows are read in parts that tasks share."""

from __future__ import annotations

from conftest import ticket
from pyspark.sql import functions as F

from ticketmill.plans import batch

def test_a_large_landed_file_is_read_in_parts(spark, bronze, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "LANDED_ROW_GROUP", 64 * 1024)
    row = bronze([ticket()]).drop("_row_id")
    many = spark.range(20_000).coalesce(1).select(F.col("id").alias("_row_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    landed = batch.land(many.crossJoin(F.broadcast(row)).withColumn("customer_text", F.col("text")).drop("text"), str(tmp_path), "r1")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        sizes = [r["count"] for r in landed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(sizes) == 20_000 and len(sizes) > 3 and max(sizes) < 10_000

"""Streams give what the batch gives, batch by batch and after a restart."""

from __future__ import annotations

import os

from conftest import AS_OF, ticket
from pyspark.sql import functions as F

from ticketmill.operators import validation
from ticketmill.plans import batch
from ticketmill.schemas import BRONZE, EXECUTION_ID
from ticketmill.streaming import tickets as streams


def drop_file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    lines = [",".join(BRONZE.names)] + [",".join(f'"{v}"' if v else "" for v in row) for row in rows]
    with open(f"{folder}/{name}.csv", "w") as file:
        file.write("\n".join(lines) + "\n")


def ingest(spark, regions, source, root):
    streams.ingest(streams.read_stream(spark, source, files_per_batch=1), regions, AS_OF, root).awaitTermination()


def test_new_files_only_and_keep_latest_over_batches(spark, regions, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    drop_file(source, "a", [ticket(), ticket(customer_text="NA"), ticket(email_address="b@b.c")])
    ingest(spark, regions, source, root)
    assert batch.read_validated(spark, root).count() == 2
    drop_file(source, "b", [ticket(created_at="2026-06-03 00:00:00"), ticket(created_at="2026-06-02 00:00:00")])
    drop_file(source, "c", [ticket(email_address="b@b.c", created_at="2026-05-01 00:00:00")])
    ingest(spark, regions, source, root)
    ingest(spark, regions, source, root)
    validated = batch.read_validated(spark, root)
    assert validated.count() == 4 and validated.select(EXECUTION_ID).distinct().count() == 3
    current = {r.email_address: str(r.created_at) for r in streams.current_tickets(validated).collect()}
    assert current == {"alice_1@example.org": "2026-06-03 00:00:00", "b@b.c": "2026-06-01 10:00:00"}
    reasons = sorted(r.failure_reason for r in batch.read_quarantine(spark, root).collect())
    assert reasons == ["Duplicate email and text", "customer_text is NULL or blank"]


def test_a_repeated_batch_changes_nothing(spark, regions, bronze, tmp_path):
    root = str(tmp_path / "lake")
    raw = bronze([ticket(), ticket(), ticket(region=None)])
    for _ in range(2):
        batch.judge(batch.land(raw, root, "batch_0"), regions, AS_OF, root, "batch_0")
    assert (batch.read_validated(spark, root).count(), batch.read_quarantine(spark, root).count()) == (1, 2)


def test_stream_equals_batch(spark, regions, bronze, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    rows = [ticket(email_address=f"u{i % 7}@x.y", created_at=f"2026-06-0{i % 9 + 1} 0{i % 10}:00:00") for i in range(60)]
    for n in range(3):
        drop_file(source, f"f{n}", rows[n * 20 : n * 20 + 20])
    ingest(spark, regions, source, root)
    key = ["email_address", "customer_text", "created_at"]
    streamed = streams.current_tickets(batch.read_validated(spark, root)).select(*key)
    whole = validation.valid_tickets(validation.check_tickets(bronze(rows), regions, AS_OF)).select(*key)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, whole.collect()))


def test_trend_grows_over_triggers(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "trend")

    def trend():
        stream = streams.typed_stream(streams.read_stream(spark, source, files_per_batch=1))
        return {r.created_date: r.ticket_count for r in streams.run_hourly_trend(stream, root).collect()}

    drop_file(source, "a", [ticket(), ticket(created_at="2026-06-01 10:59:59"), ticket(created_at="nope")])
    assert trend() == {"2026-06-01 10:00": 2}
    drop_file(source, "b", [ticket(), ticket(created_at="2026-06-01 11:00:00")])
    assert trend() == {"2026-06-01 10:00": 3, "2026-06-01 11:00": 1}


def test_late_rows_count_without_a_watermark(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "trend")

    def trend():
        stream = streams.typed_stream(streams.read_stream(spark, source, files_per_batch=1))
        return {r.created_date: r.ticket_count for r in streams.run_hourly_trend(stream, root).collect()}

    drop_file(source, "a", [ticket(), ticket(created_at="2026-06-09 11:00:00")])
    assert trend() == {"2026-06-01 10:00": 1, "2026-06-09 11:00": 1}
    drop_file(source, "b", [ticket(), ticket(created_at="2020-01-01 00:00:00")])
    assert trend() == {"2020-01-01 00:00": 1, "2026-06-01 10:00": 2, "2026-06-09 11:00": 1}


def test_first_copies(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    drop_file(source, "a", [ticket(), ticket(created_at="2099-06-01 12:00:00")])
    drop_file(source, "b", [ticket(created_at="2020-06-01 13:00:00"), ticket(customer_text="other")])
    stream = streams.typed_stream(streams.read_stream(spark, source, files_per_batch=1))
    kept = streams.run_first_copies(stream, root).groupBy("customer_text").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.customer_text: r.n for r in kept} == {"How do I reset it?": 1, "other": 1}
    within = streams.first_copies(streams.typed_stream(streams.read_stream(spark, source), AS_OF), "1 day")
    assert within.isStreaming


def test_streams_into_one_root_keep_all_rows(spark, regions, tmp_path):
    root = str(tmp_path / "lake")
    for name in ("one", "two"):
        drop_file(str(tmp_path / name), name, [ticket(), ticket(email_address=f"{name}@x.y")])
        stream = streams.read_stream(spark, str(tmp_path / name), multi_line=False)
        streams.ingest(stream, regions, AS_OF, root, checkpoint=str(tmp_path / f"{name}_checkpoint")).awaitTermination()
    assert batch.read_validated(spark, root).count() == 4

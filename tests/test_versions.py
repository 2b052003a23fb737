"""Loads by key, runs that are stored again, generated keys and source order."""

from __future__ import annotations

import os
import random

import pytest
from conftest import AS_OF, physical_plan, ticket
from pyspark.sql import functions as F

from ticketmill.operators import load, validation
from ticketmill.plans import batch
from ticketmill.schemas import BRONZE, EXECUTION_ID
from ticketmill.sources import files, layers, versions
from ticketmill.streaming import tickets as streams

SCHEMA = "k string, at int, v string"


def rows(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_the_newest_copy_wins_and_old_versions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.upsert(rows(spark, ("a", 1, "x"), ("b", 1, "x"), (None, 1, "x"), ("a", 2, "y")), path, ["k"], "at", buckets=4) == 1
    before = versions.read(spark, path)
    assert versions.upsert(rows(spark, ("a", 1, "late"), ("b", 1, "again"), (None, 5, "z"), ("c", None, "n")), path, ["k"], "at") == 2
    assert content(versions.read(spark, path)) == content(rows(spark, ("a", 2, "y"), ("b", 1, "again"), (None, 5, "z"), ("c", None, "n")))
    expected = [("a", 2, "y"), ("b", 1, "x"), (None, 1, "x")]
    assert content(versions.read(spark, path, 1)) == content(before) == sorted(expected, key=str)
    assert versions.versions(spark, path) == [1, 2]
    with pytest.raises(ValueError, match="no version 7"):
        versions.read(spark, path, 7)


@pytest.mark.parametrize("merge_at", [0.0, 0.5, 2.0])
def test_any_order_of_loads_gives_the_same_table(spark, tmp_path, merge_at):
    pick = random.Random(int(merge_at * 10))
    loads = [[(f"k{pick.randint(0, 30)}", pick.randint(0, 5), f"v{pick.randint(0, 9)}") for _ in range(pick.randint(1, 40))] for _ in range(5)]
    best = {}
    for row in (r for one in loads for r in one):
        if row[0] not in best or (-row[1], row[2]) < (-best[row[0]][1], best[row[0]][2]):
            best[row[0]] = row
    for name in ("one", "two"):
        path = str(tmp_path / name)
        for one in loads:
            versions.upsert(rows(spark, *one), path, ["k"], "at", ["v"], buckets=5, merge_at=merge_at)
        assert content(versions.read(spark, path)) == sorted(best.values(), key=str)
        loads.reverse()


def test_a_load_reads_and_writes_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.upsert(rows(spark, *[(f"k{i}", 1, "x") for i in range(200)]), path, ["k"], "at", buckets=16)
    versions.upsert(rows(spark, ("k7", 2, "y")), path, ["k"], "at")
    first, second = (versions.manifest(spark, path, v).parts for v in (1, 2))
    changed = [b for b in first if first[b] != second[b]]
    assert len(first) == 16 and len(changed) == 1 and len(second[changed[0]]) == 1
    versions.upsert(rows(spark, ("k7", 3, "z")), path, ["k"], "at", merge_at=0.5)
    third = versions.manifest(spark, path, 3).parts
    assert len(third[changed[0]]) == 2 and third[changed[0]][1][1] == 1
    assert versions.read(spark, path).where("k = 'k7'").collect()[0].v == "z"


def test_rows_are_rewritten_a_logarithm_of_times(spark, tmp_path):
    path, written = str(tmp_path / "t"), 0
    for i in range(16):
        versions.upsert(rows(spark, *[(f"k{i}_{j}", 1, "x") for j in range(20)]), path, ["k"], "at", buckets=1, merge_at=0.5)
        written += sum(n for folder, n in versions.manifest(spark, path).parts["0"] if folder.startswith(f"{i + 1:08d}"))
    assert versions.read(spark, path).count() == 320
    assert written < 320 * 6 < sum(20 * (i + 1) for i in range(16))


def test_two_loads_at_a_time_and_one_that_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.upsert(rows(spark, ("a", 1, "x")), path, ["k"], "at")
    files.write_text(spark, f"{path}/versions/00000002.json", files.read_text(spark, f"{path}/versions/00000001.json").replace('"version": 1', '"version": 2'))
    with pytest.raises(Exception, match="exist"):
        files.write_text(spark, f"{path}/versions/00000002.json", "{}")
    failing = rows(spark, ("b", 1, "x")).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        versions.upsert(failing, path, ["k"], "at")
    assert content(versions.read(spark, path)) == [("a", 1, "x")]
    with pytest.raises(ValueError, match="the table has keys"):
        versions.upsert(rows(spark, ("b", 1, "x")), path, ["v"], "at")


def test_no_rows_and_unused_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.upsert(rows(spark, ("a", 1, "x")).limit(0), path, ["k"], "at")
    assert versions.read(spark, path).collect() == []
    for i in range(3):
        versions.upsert(rows(spark, ("a", i, str(i))), path, ["k"], "at")
    gone = versions.vacuum(spark, path, keep=1)
    assert gone and content(versions.read(spark, path)) == [("a", 2, "2")] and versions.versions(spark, path) == [4]
    assert versions.vacuum(spark, path, keep=1) == []


def test_an_outcome_that_becomes_empty_leaves_no_rows(spark, regions, bronze, tmp_path):
    root = str(tmp_path / "lake")

    def outcomes(*raw):
        counts = batch.judge(batch.land(bronze(list(raw)), root, "r"), regions, AS_OF, root, "r")
        stored = (batch.read_validated(spark, root).count(), batch.read_quarantine(spark, root).count())
        assert (counts["rows_valid"], counts["rows_quarantined"]) == stored
        return stored

    assert outcomes(ticket(), ticket(region=None)) == (1, 1)
    assert outcomes(ticket()) == (1, 0)
    assert outcomes(ticket(region=None)) == (0, 1)
    assert outcomes() == (0, 0)


def test_a_stream_that_begins_anew_in_the_same_folder(spark, regions, tmp_path):
    root, source = str(tmp_path / "lake"), tmp_path / "in"
    for name in ("a", "b"):
        os.makedirs(source / name)
        lines = [",".join(BRONZE.names), ",".join(f'"{v}"' if v else "" for v in ticket(email_address=f"{name}@x.y"))]
        (source / name / "f.csv").write_text("\n".join(lines) + "\n")
        stream = streams.read_stream(spark, str(source / name))
        streams.ingest(stream, regions, AS_OF, root, keep_current=True).awaitTermination()
        files.move(spark, f"{root}/_checkpoint", f"{root}/_old_{name}")
    assert batch.read_validated(spark, root).select(EXECUTION_ID).distinct().count() == 2
    assert streams.read_current(spark, root).count() == 2


def test_current_tickets_do_not_depend_on_the_order_of_files(spark, regions, tmp_path):
    pick, found = random.Random(2), []
    raw = [ticket(email_address=f"u{pick.randint(0, 5)}@x.y", created_at=f"2026-06-0{pick.randint(1, 3)} 00:00:00", first_response_at=f"2026-06-09 0{pick.randint(0, 9)}:00:00") for _ in range(60)]
    for order in (1, -1):
        source, root = tmp_path / f"in{order}", str(tmp_path / f"lake{order}")
        os.makedirs(source)
        for n, at in enumerate(range(0, 60, 15)[::order]):
            lines = [",".join(BRONZE.names)] + [",".join(f'"{v}"' for v in r) for r in raw[at : at + 15]]
            (source / f"f{n}.csv").write_text("\n".join(lines) + "\n")
        streams.ingest(streams.read_stream(spark, str(source), files_per_batch=1), regions, AS_OF, root, keep_current=True).awaitTermination()
        key = ["email_address", "created_at"]
        found.append(content(streams.read_current(spark, root).select(*key)))
        assert found[-1] == content(streams.current_tickets(batch.read_validated(spark, root)).select(*key))
    assert found[0] == found[1]


def test_dense_keys_follow_files_not_splits(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(7).write.parquet(path)
    keyed = load.with_dense_key(spark.read.parquet(path), "n", 5)
    once = {r.id: r.n for r in keyed.collect()}
    assert sorted(once.values()) == list(range(6, 1006))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert {r.id: r.n for r in load.with_dense_key(spark.read.parquet(path), "n", 5).collect()} == once
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert load.with_dense_key(spark.read.parquet(path).where("id < 0"), "n").collect() == []


def test_rows_are_numbered_as_in_their_files(spark, tmp_path):
    source, placed = tmp_path / "in", str(tmp_path / "placed")
    os.makedirs(source)
    for n in range(3):
        lines = [",".join(BRONZE.names)] + [",".join(ticket(email_address=f"{n}_{k:04d}@x.y")[:4]) + "," for k in range(400)]
        (source / f"f{n}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        layers.with_source_place(layers.read_bronze_csv(spark, str(source), multi_line=False)).write.parquet(placed)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    numbered = layers.in_source_order(layers.numbered_in_source_order(spark.read.parquet(placed))).collect()
    assert [r.email_address for r in numbered] == [f"{n}_{k:04d}@x.y" for n in range(3) for k in range(400)]
    assert [r._row_id for r in numbered] == list(range(1, 1201))


@pytest.mark.parametrize("bits", [64, 1 << 27])
def test_judging_by_filter_gives_the_same_verdicts(spark, regions, bronze, bits):
    pick = random.Random(bits)
    raw = bronze([ticket(email_address=f"u{pick.randint(0, 60)}@x.y", created_at=f"2026-06-0{pick.randint(1, 9)} 00:00:00", region=pick.choice(["JP-TOKYO", None])) for _ in range(150)])
    expected = validation.judge_tickets(validation.check_tickets(raw, regions, AS_OF))
    found = validation.judge_tickets_by_filter(raw, regions, AS_OF, bits)
    assert content(found.select("_row_id", "failure_reason")) == content(expected.select("_row_id", "failure_reason"))


def test_unique_rows_are_not_shuffled(spark, regions, bronze, tmp_path):
    """Only the rows that the filter holds meet an exchange of all columns."""
    bronze([ticket(email_address=f"u{i}@x.y") for i in range(500)] + [ticket(), ticket()]).write.parquet(str(tmp_path / "b"))
    raw = spark.read.parquet(str(tmp_path / "b"))
    judged = validation.judge_tickets_by_filter(raw, regions, AS_OF)
    judged.collect()
    plan = physical_plan(judged)
    alone = plan.split("Union")[1].split("SortMergeJoin")[0] if "SortMergeJoin" in plan else plan
    assert "BroadcastHashJoin" in alone
    assert judged.where("failure_reason <> ''").count() == 1

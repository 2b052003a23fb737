from __future__ import annotations

import uuid
from types import SimpleNamespace

import pytest
from conftest import AS_OF, physical_plan, ticket
from pyspark.sql import functions as F

from ticketmill.fixed_values import NA_TOKENS
from ticketmill.operators import validation
from ticketmill.operators.constraints import orphans
from ticketmill.operators.lookup import flag_members, lookup_stage_ids, lookup_value, reference_mapping
from ticketmill.plans import shared
from ticketmill.schemas import EXECUTION_ID, ROW_ID
from ticketmill.sources import layers, reference_data

ODD_TEXTS = ['He said "no", twice', "a,b", "line\nbreak", "back\\slash \\\" end\\", "  spaces  ", "tab\tx", "#1", "ünï", "'", '"']


@pytest.fixture
def folder(tmp_path):
    return lambda: str(tmp_path / uuid.uuid4().hex)


def test_odd_texts_survive_a_csv_file(spark, bronze, folder):
    path = folder()
    layers.write_csv(bronze([ticket(customer_text=t) for t in ODD_TEXTS]), path)
    back = layers.read_bronze_csv(spark, path).orderBy(F.col(ROW_ID).cast("int")).collect()
    assert [r.customer_text for r in back] == ODD_TEXTS
    assert [r.first_response_at for r in back] == [None] * len(ODD_TEXTS)


def test_missing_tokens_become_null(spark, bronze, folder):
    path = folder()
    layers.write_csv(bronze([ticket(customer_text=t) for t in [*NA_TOKENS, "nA", "none"]]), path)
    texts = [r.customer_text for r in layers.read_bronze_csv(spark, path).collect()]
    assert sorted(t for t in texts if t is not None) == ["nA", "none"]
    kept = layers.read_bronze_csv(spark, path, na_tokens=[""]).where("customer_text IS NOT NULL").count()
    assert kept == len(NA_TOKENS) - 1 + 2


def test_columns_are_bound_by_name(spark, tmp_path):
    file = tmp_path / "raw_support_tickets_20260602_211114.csv"
    file.write_text(
        "region,customer_text,extra,created_at,first_response_at,email_address\n"
        "JP-TOKYO,hello,1,2026-06-01 10:00:00,,a@b.c\n"
    )
    raw = layers.read_bronze_csv(spark, str(file)).withColumn(EXECUTION_ID, layers.run_of_file()).first()
    assert (raw.email_address, raw.region, raw.extra, raw.first_response_at) == ("a@b.c", "JP-TOKYO", "1", None)
    assert raw.execution_id == "20260602_211114"


def test_files_of_another_layout_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticket_id,created_at,customer_text,region,first_response_at\n1,2,3,4,5\n")
    with pytest.raises(ValueError, match="Missing required columns: .'email_address'."):
        layers.read_bronze_csv(spark, str(tmp_path))


def test_row_ids_rise_in_file_order(spark, tmp_path):
    file = tmp_path / "a.csv"
    lines = "".join(f"u{i}@b.c,2026-06-01,t{i},JP-TOKYO,\n" for i in range(500))
    file.write_text("email_address,created_at,customer_text,region,first_response_at\n" + lines)
    rows = layers.with_row_ids(layers.read_bronze_csv(spark, str(file))).orderBy(ROW_ID).collect()
    assert [r.customer_text for r in rows] == [f"t{i}" for i in range(500)]


def test_one_run_is_replaced_and_read_alone(spark, folder):
    path = folder()
    df = spark.createDataFrame([("007", 1), ("007", 2), ("008", 3)], f"{EXECUTION_ID} string, n int")
    layers.write_runs(df, path)
    layers.write_runs(df.where("n = 3").withColumn("n", F.lit(4)), path)
    layers.write_run(df.where("n = 1").withColumn("n", F.lit(9)), path, "007")
    assert sorted(tuple(r) for r in layers.read_layer(spark, path).select(EXECUTION_ID, "n").collect()) == [
        ("007", 9), ("008", 4),
    ]
    layers.write_run(df.limit(0), path, "007")
    assert [r.n for r in layers.read_layer(spark, path).collect()] == [4]
    assert layers.read_layer(spark, path, "007").isEmpty()
    assert [tuple(r) for r in layers.read_layer(spark, path, "008").select(EXECUTION_ID, "n").collect()] == [("008", 4)]
    assert all("/execution_id=008/" in file for file in layers.read_layer(spark, path, "008").inputFiles())
    later = layers.read_layer(spark, path).where(F.col(EXECUTION_ID) > "007")
    assert "PartitionFilters: [isnotnull(execution_id" in physical_plan(later)


def test_a_large_run_is_written_by_several_tasks(spark, folder):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, path = spark.conf.get(size), folder()
    run = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 5))
    spark.conf.set(size, "100k")
    try:
        layers.write_runs(
            spark.range(60_000).select(run.alias(EXECUTION_ID), F.sha2(F.col("id").cast("string"), 256).alias("t")), path
        )
    finally:
        spark.conf.set(size, before)
    assert len(layers.read_layer(spark, path, "hot").inputFiles()) > 3


def test_append_repeats_and_append_new_does_not(spark, folder):
    path = folder()
    df = spark.createDataFrame([("r1", "a"), ("r1", "b")], f"{EXECUTION_ID} string, k string")
    layers.append_runs(df, path)
    layers.append_runs(df, path)
    assert layers.read_layer(spark, path).count() == 4
    layers.append_new(df.union(spark.createDataFrame([("r2", "c")], df.schema)), path, ["k"])
    assert sorted(r.k for r in layers.read_layer(spark, path).collect()) == ["a", "a", "b", "b", "c"]


def test_write_if_rows(spark, folder):
    path = folder()
    assert not layers.write_if_rows(spark.range(0), lambda df: df.write.parquet(path))
    assert layers.write_if_rows(spark.range(2), lambda df: df.write.parquet(path))
    assert spark.read.parquet(path).count() == 2


def test_seeded_tables(spark):
    assert [r.region_id for r in reference_data.dim_regions(spark).orderBy("region_id").collect()] == [1, 2, 3, 4, 5]
    assert reference_data.dim_categories(spark).count() == 6
    stages, pipelines = reference_data.stages(spark), reference_data.pipelines(spark)
    assert lookup_stage_ids(stages, pipelines, "AI_SUPPORT", "AI Enrichment").first().stage_id == 3
    assert lookup_stage_ids(stages, pipelines, "OTHER", "AI Enrichment").first() is None
    config = reference_data.configuration(spark)
    assert reference_data.config_value(config, "MAX_RETRIES") == "3"
    assert reference_data.config_value(config, "NOT_A_KEY") is None
    twice = config.unionByName(config.withColumn("config_value", F.lit("2")))
    assert reference_data.config_value(twice, "MAX_RETRIES") == "3"
    assert reference_data.config_values(twice, ["MAX_RETRIES"]).first()[0] == "3"
    assert tuple(reference_data.config_values(config, ["MODEL_NAME", "X"]).first()) == ("gemini-2.5-flash", None)


def test_lookups_never_multiply_rows(spark):
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "name string, id int")
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), (" a",)], "k string")
    assert {r.k: r.id for r in lookup_value(df, "k", dim, "name", "id").collect()} == {
        "a": 2, "b": None, "c": None, None: None, " a": None,
    }
    assert {r.k: r.hit for r in flag_members(df, "k", dim, "name", "hit").collect()} == {
        "a": True, "b": True, "c": False, None: False, " a": False,
    }
    assert reference_mapping(dim, "name", "id").count() == 2


def test_keys_of_different_types_still_meet(spark):
    rows = spark.sql("SELECT CAST(id AS INT) AS k, CAST(id AS DOUBLE) AS d, CAST(-id AS DOUBLE) * 0 AS zero FROM range(3)")
    dim = spark.range(2).withColumnRenamed("id", "name").withColumn("value", F.col("name") + 10)
    for key in ("k", "d"):
        assert sorted((r.k, r.value) for r in lookup_value(rows, key, dim, "name", "value").collect()) == [
            (0, 10), (1, 11), (2, None),
        ]
        assert [r.k for r in orphans(rows, key, dim, "name").collect()] == [2]
    assert orphans(rows, "zero", rows.select(F.lit(0.0).alias("z")), "z").isEmpty()


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, bronze, regions):
    plan = physical_plan(validation.check_tickets(bronze([ticket()]), regions, AS_OF))
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan
    large = spark.range(5_000_000).select(F.col("id").cast("string").alias("region_name"))
    plan = physical_plan(validation.check_tickets(bronze([ticket()]), large, AS_OF))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def session(folder, master="yarn"):
    """The parts of a session that the choice of the folder looks at."""
    made = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder or default), sparkContext=context)


def test_the_shared_folder_is_the_clusters():
    assert shared.shared_folder(session("hdfs:///folder/")) == "hdfs:///folder"
    assert shared.new_folder(session("hdfs:///folder"), "x").startswith("hdfs:///folder/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(session(None))
    local = session(None, master="local[8]")
    assert shared.shared_folder(local) == shared.shared_folder(local)


def test_windows_line_ends_and_byte_order_mark(spark, tmp_path):
    lines = ["email_address,created_at,customer_text,region,first_response_at", 'a@b.c,2026-06-01,"x, y",JP-TOKYO,', ""]
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + "\r\n".join(lines).encode())
    for multi_line in (True, False):
        row = layers.read_bronze_csv(spark, str(tmp_path), multi_line=multi_line).first()
        assert (row.email_address, row.customer_text, row.first_response_at) == ("a@b.c", "x, y", None)


def test_a_failing_rerun_leaves_the_stored_run(spark, folder):
    path = folder()
    df = spark.createDataFrame([(1, "r:1"), (2, "r:1")], "n int, execution_id string")
    layers.write_run(df, path, "r:1")
    with pytest.raises(Exception):
        layers.write_run(df.withColumn("n", F.raise_error(F.lit("no")).cast("int")), path, "r:1")
    assert sorted(r.n for r in layers.read_layer(spark, path, "r:1").collect()) == [1, 2]
    layers.write_run(df.limit(0), path, "r:1")
    assert layers.read_layer(spark, path, "r:1", df.schema).count() == 0


def test_append_new_begins_a_table(spark, folder):
    path, rows = folder(), spark.createDataFrame([("r1", "a"), ("r1", "a"), ("r1", "b")], "execution_id string, k string")
    for _ in range(2):
        layers.append_new(rows, path, ["k"])
    assert sorted(r.k for r in layers.read_layer(spark, path).collect()) == ["a", "b"]

"""Reading and writing the layers.

Paths are whatever URI Spark's file systems understand, so an object store needs no staging copy.
Every stored layer is a Parquet directory partitioned by run id: reading one run prunes to its
partition, and rerunning it replaces that partition alone.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.fixed_values import NA_TOKENS
from ticketmill.functions.text import null_missing
from ticketmill.operators.dedup import drop_known
from ticketmill.operators.validation import require_columns
from ticketmill.schemas import EXECUTION_ID, ROW_ID
from ticketmill.sources import files
from ticketmill.sources.files import exists

RUN_IN_FILE_NAME = r"(\d{8}_\d{6})"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
SOURCE_FILE, SOURCE_BLOCK, SOURCE_PLACE = "_source_file", "_source_block", "_source_place"
ESCAPED_IN_PATHS = r"""[\x01-\x1f"#%'*/:=?\\{\[\]^\x7f]"""


def _csv_options(multi_line: bool) -> dict[str, object]:
    return {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "enforceSchema": False}


def csv_columns(spark: SparkSession, path: str) -> T.StructType:
    """The header of the files as an all-text schema, in file order."""
    names = spark.read.option("header", True).csv(path).columns
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Does a quoted text go on in the next line? Then some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_bronze_csv(
    spark: SparkSession, path: str, multi_line: bool | None = None, na_tokens: Sequence[str] = NA_TOKENS
) -> DataFrame:
    """Raw ticket files as text columns, bound by header name, missing-value tokens as null.

    Files whose header differs from the first one are refused. `multi_line` allows line breaks inside
    quoted text but makes a file one task; unless given, the files are looked through for such texts,
    so that files without them are read in as many tasks as they have blocks.
    """
    schema = csv_columns(spark, path)
    multi_line = has_broken_lines(spark, path) if multi_line is None else multi_line
    raw = spark.read.options(**_csv_options(multi_line)).schema(schema).csv(path)
    return null_missing(require_columns(raw), na_tokens)


def run_of_file() -> Column:
    """The run id in the name of the file a row came from; '' when there is none."""
    return F.regexp_extract(F.col("_metadata.file_name"), RUN_IN_FILE_NAME, 1)


def with_row_ids(df: DataFrame) -> DataFrame:
    """Number the rows, rising in file order. Store the result before using the ids: they belong
    to one reading of the source."""
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def with_source_place(df: DataFrame) -> DataFrame:
    """Add where each row of a table of files stands: its file, the block of it that one task reads, and a
    number that rises by one from row to row of a block. Store the result, then `numbered_in_source_order`."""
    return df.select(
        "*", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias(SOURCE_BLOCK),
        F.monotonically_increasing_id().alias(SOURCE_PLACE),
    )


def numbered_in_source_order(placed: DataFrame, column: str = ROW_ID, start_after: int = 0) -> DataFrame:
    """Number stored rows with their place from `start_after` + 1 on, without gaps, as they stood in the source:
    files by name, then blocks, then rows.

    A row's number is the rows of all blocks before its own, plus its place in the block. Only one row for each block
    is sorted; the rows themselves are not moved.
    """
    block = [SOURCE_FILE, SOURCE_BLOCK]
    blocks = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("_rows"), F.min(SOURCE_PLACE).alias("_first"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(*block, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col(SOURCE_PLACE) - F.col("_first") + F.lit(start_after + 1)
    return placed.join(starts, block).withColumn(column, number).drop(*block, SOURCE_PLACE, "_first", "_before")


def in_source_order(df: DataFrame) -> DataFrame:
    """Sorted as the source was, for a sink that asks for it; no operator depends on the order."""
    return df.orderBy(ROW_ID)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).options(
        header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def run_path(path: str, run: str) -> str:
    """The folder of a run, its id escaped as Spark escapes partition values."""
    escaped = re.sub(ESCAPED_IN_PATHS, lambda c: f"%{ord(c[0]):02X}", run)
    return f"{path}/{EXECUTION_ID}={escaped}"


def stage_run(df: DataFrame, path: str, partition_by: Sequence[str] = (), row_group: int | None = None) -> str:
    """Write the rows of a run beside the table, where no reader looks; returns the folder.

    Without rows there is a file nevertheless, so that the columns can be read. `row_group` bounds the bytes of
    what one task at least has to read of a file, however few tasks wrote it.
    """
    options = {} if row_group is None else {"parquet.block.size": row_group}
    staged = f"{path.rstrip('/').rpartition('/')[0]}/_staged-{uuid.uuid4().hex}"
    own = df.drop(EXECUTION_ID)
    own.write.options(**options).partitionBy(*partition_by).parquet(staged)
    if partition_by and not any("=" in name for name in files.names(df.sparkSession, staged)):
        nowhere = "/".join(f"{column}={NO_VALUE}" for column in partition_by)
        own.limit(0).drop(*partition_by).write.parquet(f"{staged}/{nowhere}")
    return staged


def publish_run(spark: SparkSession, staged: str, path: str, run: str) -> None:
    """Let a staged folder take the place of the run's folder, whatever that held."""
    files.replace(spark, staged, run_path(path, run), f"{path}/_replaced-{uuid.uuid4().hex}")


def write_run(
    df: DataFrame, path: str, run: str, partition_by: Sequence[str] = (), row_group: int | None = None
) -> None:
    """Replace one run's folder as a whole, also when the run, or one of its sub-partitions, has no rows left.

    Safe to repeat. The new folder takes the place of the old one when it is complete, so a write that
    fails leaves the stored run readable.
    """
    publish_run(df.sparkSession, stage_run(df, path, partition_by, row_group), path, run)


def write_runs(df: DataFrame, path: str) -> None:
    """Replace the partitions of all runs in the table and leave the others alone.

    Rebalancing groups rows by run before the write, and splits a run that is large, so many small
    runs do not multiply into files and one large run does not sit in one task.
    """
    df.hint("rebalance", EXECUTION_ID).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(EXECUTION_ID).parquet(path)


def append_runs(df: DataFrame, path: str) -> None:
    """Plain append: all rows or none, and once more if repeated."""
    df.write.mode("append").partitionBy(EXECUTION_ID).parquet(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the rows whose key the stored table does not hold yet, one for each key.

    The first load finds no table and stores all keys.
    """
    offered = df.dropDuplicates(list(keys))
    append_runs(drop_known(offered, read_layer(df.sparkSession, path), keys) if exists(df.sparkSession, path) else offered, path)


def read_layer(
    spark: SparkSession, path: str, run: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A stored layer, or one run of it. The run id stays text even when it looks like a number.

    One run is read from its own folder, so the folders of all other runs are not even listed. Give
    the schema where it is known: it saves reading a footer and listing the files twice.
    """
    reader = spark.read.option("basePath", path)
    folder = path if run is None else run_path(path, run)
    if schema is None:
        found = reader.parquet(folder).schema
        schema = T.StructType(
            [T.StructField(f.name, T.StringType() if f.name == EXECUTION_ID else f.dataType, True) for f in found]
        )
    return reader.schema(schema).parquet(folder)


def write_if_rows(df: DataFrame, write: Callable[[DataFrame], None]) -> bool:
    """Write only a table that has rows; tells whether it did. Meant for a stored table."""
    if df.isEmpty():
        return False
    write(df)
    return True

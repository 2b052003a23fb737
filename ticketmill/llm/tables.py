"""Intermediate tables below the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.plans.shared import new_folder

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
UNSET_BATCH_BYTES = "67108864b"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet and read again: its rows are computed once and outlive lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of `stored` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at a few megabytes of texts, in a session that has not set their size.

    The default counts rows only, and thousands of long texts at once do not fit beside a small executor.
    """
    if spark.conf.get(BATCH_BYTES) == UNSET_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, str(4 << 20))


def remainder_of_id(column: str, divisor: int):
    """crc32 of the id as text, modulo `divisor`; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(name: str, *tables: DataFrame) -> str:
    """`name`, with as many underscores before it as let no column of the tables be called so."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name

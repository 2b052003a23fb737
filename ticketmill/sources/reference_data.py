"""Seeded tables and lookups in configuration tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import fixed_values, schemas


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small table held in the plan, whose exact size lets Spark decide on a broadcast join.

    One partition, so bringing it to one row per key needs no exchange.
    """
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    arrow = {
        T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.StringType(): pa.string(),
        T.DoubleType(): pa.float64(),
    }
    fields = [pa.array(list(c), type=arrow[f.dataType]) for c, f in zip(columns, schema.fields)]
    return spark.createDataFrame(pa.table(fields, names=schema.names), schema=schema).coalesce(1)


def dim_regions(spark: SparkSession) -> DataFrame:
    return local_table(spark, fixed_values.REGIONS, schemas.DIM_REGIONS)


def dim_categories(spark: SparkSession) -> DataFrame:
    return local_table(spark, fixed_values.CATEGORIES, schemas.DIM_CATEGORIES)


def pipelines(spark: SparkSession) -> DataFrame:
    return local_table(spark, fixed_values.PIPELINES, schemas.PIPELINES)


def stages(spark: SparkSession) -> DataFrame:
    return local_table(spark, fixed_values.STAGES, schemas.STAGES)


def stage_names() -> dict[int, str]:
    """Stage names by id, in stage order."""
    return {stage_id: name for stage_id, _, _, name, _ in sorted(fixed_values.STAGES, key=lambda s: s[2])}


def configuration(spark: SparkSession) -> DataFrame:
    return local_table(spark, fixed_values.CONFIGURATION, schemas.CONFIGURATION)


def config_value(config: DataFrame, key: str) -> str | None:
    """The value of one key, the largest where it stands repeatedly, None when it is absent."""
    return config.where(F.col("config_key") == key).agg(F.max("config_value")).first()[0]


def config_values(config: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values of several keys as the columns of one row, each as `config_value` gives it."""
    return config.where(F.col("config_key").isin(list(keys))).agg(
        *[F.max(F.when(F.col("config_key") == key, F.col("config_value"))).alias(key.lower()) for key in keys]
    )

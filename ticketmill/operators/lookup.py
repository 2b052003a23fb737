"""Joins against reference tables.

No join carries a broadcast hint: Spark broadcasts a side only when its size statistics are under
spark.sql.autoBroadcastJoinThreshold, and falls back to a shuffled join, whose hot keys adaptive
execution splits, when the reference table has outgrown that limit. Each reference side is brought
to one row per key first, so a lookup never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Types whose equal values have equal hashes.
HASHED = (T.StringType(), T.BinaryType(), T.DateType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def same_key(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> Column:
    """Equality of two join keys, and of their hashes where both have the same plain type.

    The hash changes no result. It gives the join a key list of its own, so Spark shuffles the
    aggregated reference side for the join instead of reusing the exchange below its aggregate. Only
    then are both join inputs plain shuffles, and only those can adaptive execution split when a key
    is hot. The names must differ between the two sides.
    """
    equal = F.col(left_key) == F.col(right_key)
    kind = left.schema[left_key].dataType
    if kind not in HASHED or kind != right.schema[right_key].dataType:
        return equal
    return (F.xxhash64(left_key) == F.xxhash64(right_key)) & equal


def reference_values(reference: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return reference.select(column).where(F.col(column).isNotNull()).distinct()


def reference_mapping(reference: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key; of several values the largest counts."""
    return reference.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))


def flag_members(df: DataFrame, column: str, reference: DataFrame, reference_column: str, flag: str) -> DataFrame:
    """Add a boolean: does the value occur, exactly as written, in the reference column?"""
    known = reference_values(reference, reference_column).select(
        F.col(reference_column).alias("_member"), F.lit(True).alias("_found")
    )
    joined = df.join(known, same_key(df, column, known, "_member"), "left")
    return joined.withColumn(flag, F.coalesce("_found", F.lit(False))).drop("_member", "_found")


def lookup_value(
    df: DataFrame, column: str, reference: DataFrame, key: str, value: str, output: str | None = None
) -> DataFrame:
    """Add the reference value of a key column; null when the key is unknown."""
    mapping = reference_mapping(reference, key, value).select(
        F.col(key).alias("_lookup_key"), F.col(value).alias(output or value)
    )
    return df.join(mapping, same_key(df, column, mapping, "_lookup_key"), "left").drop("_lookup_key")


def lookup_stage_ids(stages: DataFrame, pipelines: DataFrame, pipeline_code: str, stage_name: str) -> DataFrame:
    """The id of one stage of one pipeline, as a table with at most one row."""
    return (
        stages.join(pipelines.where(F.col("pipeline_code") == pipeline_code), "pipeline_id")
        .where(F.col("stage_name") == stage_name)
        .select("stage_id")
        .limit(1)
    )

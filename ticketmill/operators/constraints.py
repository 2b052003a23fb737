"""Table constraints as checks: the violating rows or keys come back as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.fixed_values import ACTIVE_FLAGS, ERROR_MESSAGE_LENGTH, FACT_LENGTHS, RUN_STATUSES
from ticketmill.operators.lookup import same_key
from ticketmill.operators.rules import REASON, Rule, apply_rules
from ticketmill.schemas import FACT_REQUIRED


def not_null_rules(columns: Sequence[str]) -> list[Rule]:
    return [Rule(f"{c}_not_null", c, F.col(c).isNull(), F.lit(f"{c} is NULL")) for c in columns]


def in_set_rules(allowed: Mapping[str, Sequence[str]]) -> list[Rule]:
    """Null passes, as in an SQL CHECK."""
    return [
        Rule(f"{c}_in_set", c, ~F.col(c).isin(list(values)), F.concat(F.lit(f"{c} not allowed: "), F.col(c)))
        for c, values in allowed.items()
    ]


def max_length_rules(lengths: Mapping[str, int], in_bytes: bool = True) -> list[Rule]:
    size = F.octet_length if in_bytes else F.length
    return [
        Rule(f"{c}_length", c, size(F.col(c)) > n, F.lit(f"{c} is longer than {n}"))
        for c, n in lengths.items()
    ]


def fact_rules(lengths: Mapping[str, int] = FACT_LENGTHS) -> list[Rule]:
    return not_null_rules(FACT_REQUIRED) + max_length_rules(lengths)


def run_rules() -> list[Rule]:
    return (
        not_null_rules(["execution_id", "stage_id"])
        + in_set_rules({"run_status": RUN_STATUSES})
        + max_length_rules({"execution_id": 20, "error_message": ERROR_MESSAGE_LENGTH})
    )


def pipeline_rules() -> list[Rule]:
    return not_null_rules(["pipeline_code", "pipeline_name"]) + in_set_rules({"is_active": ACTIVE_FLAGS})


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the reason."""
    judged = apply_rules(df, rules)
    return judged.where(F.col(REASON) != "")


def require_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Fail when any row breaks a rule, as a table with constraints refuses the whole insert."""
    broken = violations(df, rules).select(REASON).limit(1).first()
    if broken:
        raise ValueError(f"constraint violated: {broken[REASON]}")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Rows with a null key part are not compared."""
    present: Column = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return (
        df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent.

    The parent is cut to distinct keys; a hot child key is split by adaptive execution.
    """
    keys = parent.select(F.col(key).alias("_parent_key")).where(F.col("_parent_key").isNotNull()).distinct()
    return child.where(F.col(foreign_key).isNotNull()).join(
        keys, same_key(child, foreign_key, keys, "_parent_key"), "left_anti"
    )

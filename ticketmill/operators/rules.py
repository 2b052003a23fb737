"""Data-quality rules as data: a name, a failing condition and a message."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.fixed_values import REASON_SEPARATOR

REASON = "failure_reason"
FAILED_RULES = "failed_rules"


@dataclass(frozen=True)
class Rule:
    """A row fails when `failed` is true; null counts as passed, as in an SQL CHECK.

    Rules naming the same `subject` stop at their first failure, in list order.
    """

    name: str
    subject: str
    failed: Column
    message: Column


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add `failure_reason`, the joined messages ('' when all pass), and `failed_rules`, their names.

    Each subject becomes one finding, a struct of name and message out of one CASE chain. Both
    results read from it, so a condition is evaluated once, also where Spark moves a filter on the
    reason below this projection.
    """
    subjects: dict[str, list[Rule]] = {}
    for rule in rules:
        subjects.setdefault(rule.subject, []).append(rule)

    findings: dict[str, Column] = {}
    for subject, (first, *rest) in subjects.items():
        chain = F.when(first.failed, _finding(first))
        for rule in rest:
            chain = chain.when(rule.failed, _finding(rule))
        findings[f"_finding_{subject}"] = chain

    names = F.concat_ws(",", *[F.col(f)["name"] for f in findings])
    return (
        df.withColumns(findings)
        .withColumns(
            {
                REASON: F.concat_ws(REASON_SEPARATOR, *[F.col(f)["message"] for f in findings]),
                FAILED_RULES: F.array_remove(F.split(names, ","), ""),
            }
        )
        .drop(*findings)
    )


def _finding(rule: Rule) -> Column:
    return F.struct(F.lit(rule.name).alias("name"), rule.message.alias("message"))

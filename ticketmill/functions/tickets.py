"""Business expressions of the ticket table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketmill.fixed_values import (
    HIGH,
    HIGH_BELOW,
    LOW,
    LOW_AT_LEAST,
    NORMAL,
    OPEN,
    RESPONDED,
    URGENT,
    URGENT_AT_MOST,
)

SEVERITY_ORDER = [URGENT, HIGH, NORMAL]


def severity(score: Column) -> Column:
    return (
        F.when(score <= URGENT_AT_MOST, URGENT)
        .when(score < HIGH_BELOW, HIGH)
        .when(score >= LOW_AT_LEAST, LOW)
        .otherwise(NORMAL)
    )


def severity_rank(level: Column) -> Column:
    """1 for the most urgent level, 4 for everything after the third."""
    return F.coalesce(
        *[F.when(level == name, rank) for rank, name in enumerate(SEVERITY_ORDER, start=1)],
        F.lit(len(SEVERITY_ORDER) + 1),
    )


def ticket_status(first_response_at: Column) -> Column:
    return F.when(first_response_at.isNull(), OPEN).otherwise(RESPONDED)


def unanswered_risk(level: Column, first_response_at: Column) -> Column:
    """A default escalation risk: unanswered urgent tickets are CRITICAL, unanswered high ones HIGH.

    Reports take the risk as an argument; this is a choice of this library, not a given rule.
    """
    waiting = first_response_at.isNull()
    return F.when(waiting & (level == URGENT), "CRITICAL").when(waiting & (level == HIGH), "HIGH")

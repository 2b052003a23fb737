"""Bounded samples of labelled rows, on which classifiers are fitted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.tables import stored

SEED = 20240501


PARTS = 1 << 30


def draw(columns: Sequence[str], seed: int = SEED) -> Column:
    """A number from 0 to `PARTS` - 1 that follows from the values of a row alone, whatever file or task it is in."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(PARTS))


def known_by(df: DataFrame, text: str = "text") -> list[str]:
    """The columns that rows are drawn by: the id, where there is one, and the text."""
    return [c for c in ("doc_id", text) if c in df.columns]


def sample_of_each(df: DataFrame, group: str, rows: int, name: str, by: Sequence[str]) -> tuple[DataFrame, dict]:
    """About `rows` rows, at most, of each value of `group`, as a written table; and the full counts.

    Rows are drawn by a hash of the columns `by`, so the same rows give the same sample in any order and
    any files; rows equal in these columns are drawn together. Rows without a group are left out. The
    values of `group` come to the driver, so they must be few: labels or languages.
    """
    counts = {r[group]: r["n"] for r in df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return df.limit(0), counts
    share = F.create_map(*[F.lit(x) for value, n in counts.items() for x in (value, min(1.0, rows / n))])
    chosen = df.where(F.col(group).isNotNull()).where(draw(by) < F.element_at(share, F.col(group)) * PARTS)
    return stored(chosen, name), counts

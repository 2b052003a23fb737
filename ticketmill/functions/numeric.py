"""Number expressions: decimal rounding, guarded parsing, percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketmill.functions.text import strip

# Number texts a model may answer with; digits may be grouped with single underscores.
DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"^[+-]?(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?$"
NOT_FINITE = r"(?i)^[+-]?(?:nan|inf|infinity)$"


def round_half_up(value: Column, places: int) -> Column:
    """Round a decimal, ties away from zero, so engines agree; returned as double."""
    return F.round(value.cast("decimal(18,6)"), places).cast("double")


def average(value: Column, places: int, kind: str = "decimal(18,6)") -> Column:
    """Mean of a decimal column, rounded half up; exact sums, so the order of rows has no say."""
    exact = value.cast(kind)
    return F.round(F.sum(exact) / F.count(exact), places).cast("double")


def percentage(part: Column, total: Column) -> Column:
    """100 * part / total with one place; null when the total is zero."""
    return round_half_up(F.try_divide(part * F.lit(100.0), total), 1)


def names_not_finite(text: Column) -> Column:
    """True for the names of NaN and the infinities, which read as floats too."""
    return strip(text).rlike(NOT_FINITE)


def to_double(text: Column) -> Column:
    """The finite number in the text, else null. The guard refuses suffixes such as 0.5f."""
    value = strip(text)
    return F.when(value.rlike(NUMBER), F.replace(value, F.lit("_"), F.lit("")).try_cast("double"))


def number_or_zero(value: Column) -> Column:
    """Any column as a double; what is not a number becomes 0.0."""
    return F.nanvl(F.coalesce(value.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def within_unit(score: Column) -> Column:
    """The score when it lies in [-1, 1], else 0.0 (NaN and infinities too)."""
    return F.when(score.between(-1.0, 1.0), score).otherwise(F.lit(0.0))

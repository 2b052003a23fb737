"""Text expressions: Unicode strip, blank test, e-mail test, substring search, missing tokens."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.fixed_values import EMAIL_PATTERN, NA_TOKENS, WHITESPACE


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (Spark's plain trim removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null and for text without a single visible character."""
    return text.isNull() | (F.ltrim(text, F.lit(WHITESPACE)) == "")


def is_email(text: Column) -> Column:
    """Does the stripped text match? Text that matches as it is, the normal case, is not stripped."""
    return text.rlike(EMAIL_PATTERN) | strip(text).rlike(EMAIL_PATTERN)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True when one of the words occurs in the text, as a plain substring."""
    return reduce(or_, [F.contains(text, F.lit(word)) for word in words])


def null_missing(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Replace the missing-value tokens by null in every string column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.when(~F.col(n).isin(list(tokens)), F.col(n)) for n in names})


def digest(*columns: Column) -> Column:
    """32-byte SHA-256 of several text columns, for grouping on long keys.

    Lengths are part of the hashed text, so ('ab','c') and ('a','bc') differ, and a null differs
    from every text. Shuffling the digest instead of the key keeps the exchanged rows small.
    """
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("~")) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))

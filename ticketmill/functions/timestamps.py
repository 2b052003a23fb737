"""Timestamp expressions on TIMESTAMP_NTZ.

Spark's timestampdiff, date_trunc and date_format take the zoned type, so a value without a zone
would pass through the session zone and move in daylight-saving gaps. Everything here stays
zone-free: differences are day-time intervals, and texts come from the plain string form.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketmill.fixed_values import (
    EARLIEST_TIME, EXECUTION_ID_FORMAT, LAST_SHORT_YEAR, LATEST_TIME, MONTHS, TIMESTAMP_FORMATS,
)
from ticketmill.functions.numeric import round_half_up
from ticketmill.functions.text import strip

NTZ = "timestamp_ntz"
ISO_DATE = r"^\d{4}(?:-\d{1,2}(?:-\d{1,2}.*)?)?$"
HAS_DIGIT = r"\d"

# The grammar of written times. Every alternative names its fields by the letters of `FIELDS`; a field that
# stands in several alternatives is filled by the one that matches.
FIELDS = ("year", "month", "day", "name", "hour", "minute", "second", "fraction", "half")
_MONTH = r"((?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?))\.?"
_WEEKDAY = r"(?:(?i:(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?)\.?,?\s+)?"
_DAY = r"(\d{1,2})(?i:st|nd|rd|th)?"
DATES = [
    (r"(\d{4})[-/.](\d{1,2})(?:[-/.](\d{1,2}))?", ["year", "month", "day"]),
    (r"(\d{4})(\d{2})(\d{2})(?:[T ]?(\d{2})(\d{2})(\d{2})?)?", ["year", "month", "day", "hour", "minute", "second"]),
    (r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})", ["month", "day", "year"]),
    (_DAY + r"[\s-]+" + _MONTH + r",?[\s-]+(\d{4}|\d{2})", ["day", "name", "year"]),
    (_MONTH + r"\s+" + _DAY + r",?\s+(\d{4})", ["name", "day", "year"]),
    (_MONTH + r",?\s+(\d{4})", ["name", "year"]),
]
CLOCK = (
    r"(?:(?:T|,?\s+)(\d{1,2})(?=:|\s*[AaPp]\.?[Mm])(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?\s*(?:([AaPp])\.?[Mm]\.?)?)?"
    r"\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})?",
    ["hour", "minute", "second", "fraction", "half"],
)
_MARK = "\x01"


def _grammar() -> tuple[str, str]:
    """One pattern for all written times, and the replacement that lists its fields between marks."""
    places: dict[str, list[int]] = {name: [] for name in FIELDS}
    group = 0
    for _, fields in [*DATES, CLOCK]:
        for name in fields:
            group += 1
            places[name].append(group)
    dates = "|".join(pattern for pattern, _ in DATES)
    listed = _MARK.join("".join(f"${g}" for g in places[name]) for name in FIELDS)
    return f"^{_WEEKDAY}(?:{dates}){CLOCK[0]}$", listed


GRAMMAR, LISTED = _grammar()


def ntz(value: datetime | str | Column) -> Column:
    """A literal without a zone; a column, such as F.localtimestamp(), stays what it is."""
    if isinstance(value, Column):
        return value.cast(NTZ)
    text = value.replace(tzinfo=None).isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast(NTZ)


def _epoch() -> Column:
    return ntz("1970-01-01 00:00:00")


def _whole(unit: str, start: Column, end: Column) -> Column:
    """Whole units between two timestamps, cut toward zero."""
    return F.call_function("div", end - start, F.expr(f"interval '1' {unit}"))


def _parse_layout(text: Column, layout: str) -> Column:
    # Parsed as UTC and counted from the epoch, so the session zone has no say.
    utc = F.try_to_timestamp(F.concat(text, F.lit(" UTC")), F.lit(f"{layout} VV"))
    return from_event_time(utc)


def _from_fields(fields: Column) -> Column:
    """The time that a list of `FIELDS` names; null where it names none."""
    part = {name: F.element_at(fields, k + 1) for k, name in enumerate(FIELDS)}

    def number(name: str, absent: int) -> Column:
        return F.coalesce(part[name].try_cast("int"), F.lit(absent))

    short = number("year", 0)
    year = F.when(F.length(part["year"]) > 2, short).otherwise(short + F.when(short <= LAST_SHORT_YEAR, 2000).otherwise(1900))
    named = _month_of(part["name"])
    first, second = F.when(part["name"] != "", named).otherwise(number("month", 0)), number("day", 1)
    swapped = (first > 12) & (second <= 12) & (F.length(part["year"]) > 0)
    hour, half = number("hour", 0), F.lower(part["half"])
    of_day = F.when(half == "", hour).when(hour <= 12, hour % 12 + F.when(half == "p", 12).otherwise(0))
    seconds = F.concat(
        F.when(part["second"] == "", "0").otherwise(part["second"]), F.lit("."), F.rpad(F.substring(part["fraction"], 1, 6), 6, "0")
    )
    made = F.try_make_timestamp_ntz(
        year, F.when(swapped, second).otherwise(first), F.when(swapped, first).otherwise(second),
        of_day, number("minute", 0), seconds.try_cast("decimal(16,6)"),
    )
    return F.when(F.size(fields) == len(FIELDS), made)


def _month_of(name: Column) -> Column:
    place = F.position(F.lower(F.substring(name, 1, 3)), F.lit("".join(MONTHS)))
    return F.call_function("div", place + 2, F.lit(3)).cast("int")


def parse_written(text: Column) -> Column:
    """The time written in the text by the grammar of this module, else null.

    One match names the fields; they are read in a lambda, which Spark does not inline into the generated
    code of the row, so the many cases cost nothing where the text is ISO.
    """
    fields = F.split(F.regexp_replace(text, GRAMMAR, LISTED), _MARK, -1)
    return F.element_at(F.transform(F.array(fields), _from_fields), 1)


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Lenient parse: ISO first, then the grammar of written times, then the given layouts; null when none fits.

    Month before day, unless that gives no month; a date without a day is the first of its month.
    A zone suffix is dropped. The ISO guard (a year, a month or more) keeps the cast from reading
    '12345' as a year. ISO text, the normal case, costs a match and a cast; only the rest is stripped
    of Unicode whitespace and tried again. Few patterns with alternatives beat many simple ones: each
    adds code to the generated method, which the JVM leaves uncompiled beyond 8000 bytes.
    """
    value = strip(text)
    again = [F.when(value.rlike(ISO_DATE), value.try_cast(NTZ)), parse_written(value), *[_parse_layout(value, f) for f in formats]]
    iso = F.when(text.rlike(ISO_DATE), text.try_cast(NTZ))
    return F.coalesce(iso, F.when(text.rlike(HAS_DIGIT), F.coalesce(*again)))


def within_clock(value: Column) -> Column:
    """The time when a 64-bit nanosecond clock can show it, else null: 9999-12-31 is no ticket time."""
    return F.when(value.between(ntz(EARLIEST_TIME), ntz(LATEST_TIME)), value)


def to_event_time(value: Column) -> Column:
    """The same clock reading as a zoned timestamp in UTC, which watermarks and windows ask for."""
    return F.timestamp_micros(_whole_micros(value))


def from_event_time(value: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(value), _epoch()).cast(NTZ)


def _whole_micros(value: Column) -> Column:
    return F.call_function("div", value - _epoch(), F.expr("interval '0.000001' second"))


def response_latency_hours(created: Column, responded: Column) -> Column:
    """Whole minutes over 60, two places; null while unanswered."""
    return round_half_up(_whole("minute", created, responded) / F.lit(60), 2)


def duration_seconds(start: Column, end: Column) -> Column:
    """Difference of the two whole seconds; null while running."""
    seconds = [_whole("second", _epoch(), t) for t in (start, end)]
    return (seconds[1] - seconds[0]).cast("double")


def _text(value: Column) -> Column:
    return value.cast("string")


def hour_label(value: Column) -> Column:
    return F.concat(F.substring(_text(value), 1, 13), F.lit(":00"))


def day_label(value: Column) -> Column:
    return F.substring(_text(value), 1, 10)


def second_label(value: Column) -> Column:
    return F.substring(_text(value), 1, 19)


def execution_label(value: datetime) -> str:
    """Run id of a start time, as it stands in file names and partition values."""
    return value.strftime(EXECUTION_ID_FORMAT)


def execution_id(value: Column) -> Column:
    """Run id of a timestamp column: yyyyMMdd_HHmmss."""
    return F.translate(F.translate(second_label(value), "-:", ""), " ", "_")

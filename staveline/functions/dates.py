"""Date text: normalising, conversion and ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAILING_DAYS = 3 * 365


def _midnight_to_date(text: Column, tails: tuple[str, ...]) -> Column:
    """``<date><tail>`` as ``yyyy-MM-dd``; all other text as it is.

    The date has a year of four digits; month and day may have one. No regular
    expression: this runs on every point of every series.
    """
    written = F.substring_index(text, "T", 1)
    tail = F.substr(text, F.length(written) + 1)
    dated = (
        tail.isin(list(tails))
        & F.length(written).between(8, 10)
        & (F.substring(written, 5, 1) == "-")
        & ~F.contains(written, F.lit(" "))
    )
    day = F.when(dated, written.try_cast("date"))
    return F.coalesce(day.cast("string"), text)


def utc_midnight_date(text: Column) -> Column:
    return _midnight_to_date(text, ("T00:00:00.000Z",))


FULL_TAILS = tuple("T00:00:00." + "0" * n for n in range(3, 7))
PARTIAL_TAIL = "T00:00:00"


def full_timestamp_date(text: Column) -> Column:
    return _midnight_to_date(text, FULL_TAILS)


def partial_timestamp_date(text: Column) -> Column:
    return _midnight_to_date(text, (PARTIAL_TAIL,))


def timestamp_date(text: Column) -> Column:
    """Either of the two forms."""
    return _midnight_to_date(text, (*FULL_TAILS, PARTIAL_TAIL))


def day_count(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def epoch_ms_date(millis: Column) -> Column:
    """Day of an epoch time in UTC, whatever the time zone of the session."""
    return F.date_from_unix_date(F.floor(millis / 86_400_000).cast("int")).cast("string")


def timestamp_text_date(text: Column) -> Column:
    """Calendar date as written: an offset in the text does not shift the day."""
    return text.cast("timestamp_ntz").cast("date").cast("string")


def in_trailing_days(day: Column, as_of: Column, days: int = TRAILING_DAYS) -> Column:
    return day.between(F.date_sub(as_of, days), as_of)


def months_before(as_of: Column, months: int = 6) -> Column:
    return F.add_months(as_of, -months)


def days_between(start: Column, end: Column) -> Column:
    """Every day from start to end, both included; empty when start is later."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>")
    )

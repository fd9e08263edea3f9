"""Ages and date-shape rules. ``as_of`` is always passed in, so results are repeatable."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000
YEAR_ONLY_MESSAGE = "a release date marked as a year must be four digits"


def instant(value: Column) -> Column:
    """Date or timestamp text as an instant; NULL when it is neither."""
    return F.try_to_timestamp(value)


def age_days(checked: Column, as_of: Column) -> Column:
    """Fractional days from ``checked`` to ``as_of`` (both TIMESTAMP)."""
    return (F.unix_micros(as_of) - F.unix_micros(checked)) / F.lit(float(MICROS_PER_DAY))


def whole_days(checked: Column, as_of: Column) -> Column:
    return F.floor(age_days(checked, as_of)).cast("int")


def year_only_ok(flag: Column, date: Column) -> Column:
    """A date flagged as year-only must be exactly four digits."""
    return ~F.coalesce(flag, F.lit(False)) | F.coalesce(
        date.rlike(r"\A[0-9]{4}\z"), F.lit(False)
    )


def is_iso_date(value: Column) -> Column:
    shaped = value.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    real = F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).isNotNull()
    return shaped & real

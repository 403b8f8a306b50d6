"""Calendar parsing and calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_DAYS = 365.25


def parse_timestamp(text: Column) -> Column:
    """Text to a zone-free timestamp; NULL when it does not parse."""
    return text.try_cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def quarter_of(day: Column) -> Column:
    """First day of the quarter, as a date."""
    return F.trunc(day, "quarter")


def month_distance(first: Column, last: Column) -> Column:
    """Calendar months between two dates, ignoring the day of month."""
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)


def calendar_columns(day: Column, origin: Column) -> dict[str, Column]:
    """Numbers a model can read from a date: trend, annual wave, weekday, month, day."""
    angle = F.lit(2.0) * F.pi() * F.dayofyear(day) / F.lit(YEAR_DAYS)
    return {
        "trend": F.datediff(day, origin),
        "sin_year": F.sin(angle),
        "cos_year": F.cos(angle),
        "weekday": F.weekday(day),
        "month": F.month(day),
        "month_day": F.dayofmonth(day),
    }

"""Traffic-light bands. Thresholds are parameters; NULL has a stated band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default thresholds of the two reports.
URGENT_BELOW_DAYS = 7
SOON_BELOW_DAYS = 15
MEDIUM_RISK_FROM = 0.20
HIGH_RISK_FROM = 0.50
AGE_BAND_STARTS = (25, 35, 45, 55, 65)


def restock_band(coverage: Column, urgent: float = URGENT_BELOW_DAYS, soon: float = SOON_BELOW_DAYS) -> Column:
    """Unknown coverage counts as urgent: nobody can say how long the stock lasts."""
    return (
        F.when(coverage.isNull() | (coverage < urgent), "urgent")
        .when(coverage < soon, "soon")
        .otherwise("watch")
    )


def risk_band(probability: Column, medium: float = MEDIUM_RISK_FROM, high: float = HIGH_RISK_FROM) -> Column:
    return (
        F.when(probability >= high, "high")
        .when(probability >= medium, "medium")
        .when(probability.isNotNull(), "low")
    )


def age_band(age: Column, first: int = 18, starts: tuple[int, ...] = AGE_BAND_STARTS) -> Column:
    """``18-24``, ``25-34``, ... and an open last band."""
    lows = (first, *starts)
    band = F.lit(f"{lows[-1]}+")
    for low, following in zip(reversed(lows[:-1]), reversed(lows[1:])):
        band = F.when(age < following, f"{low}-{following - 1}").otherwise(band)
    return band

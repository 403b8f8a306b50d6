"""Monitors that learn a table's usual behaviour from its own history.

Every window here runs over a frame with one row per (series, day) or per load, never over the
fact table: the facts are aggregated first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HISTORY = 28
MIN_HISTORY = 7
WEEKS, MIN_WEEKS = 8, 3


def daily_counts(df: DataFrame, day: Column, series: Sequence[str]) -> DataFrame:
    return df.groupBy(*series, day.alias("day")).agg(F.count("*").alias("rows"))


def _trailing(series: Sequence[str], history: int):
    return Window.partitionBy(*series).orderBy("day").rowsBetween(-history, -1)


def completeness(counts: DataFrame, series: Sequence[str], history: int = HISTORY, width: float = 3.0) -> DataFrame:
    """Days with fewer or more rows than mean +- width * stddev of the trailing days.

    Mean and variance come from exact integer sums, so every engine gets the same bits.
    """
    w = _trailing(series, history)
    n = F.count("rows").over(w).cast("double")
    total = F.sum("rows").over(w).cast("double")
    squares = F.sum(F.col("rows") * F.col("rows")).over(w).cast("double")
    out = counts.withColumns({"_n": n, "_s": total, "_q": squares}).withColumns(
        {
            "expected": F.try_divide("_s", "_n"),
            "spread": F.sqrt(
                F.try_divide(
                    F.col("_q") * F.col("_n") - F.col("_s") * F.col("_s"), F.col("_n") * (F.col("_n") - 1)
                )
            ),
        }
    )
    off = F.abs(F.col("rows") - F.col("expected")) > F.lit(width) * F.col("spread")
    return out.withColumn("anomaly", F.coalesce((F.col("_n") >= MIN_HISTORY) & off, F.lit(False))).drop(
        "_n", "_s", "_q"
    )


def every_day(counts: DataFrame, series: Sequence[str]) -> DataFrame:
    """A row for every day between a series' first and last one; days without rows count zero."""
    spans = counts.groupBy(*series).agg(F.min("day").alias("_from"), F.max("day").alias("_to"))
    days = spans.select(*series, F.explode(F.sequence("_from", "_to", F.expr("interval 1 day"))).alias("day"))
    known = counts.select(*[F.col(c).alias(f"_{c}") for c in series], F.col("day").alias("_day"), "rows")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in series]
    filled = days.join(known, [*same, F.col("day") == F.col("_day")], "left")
    return filled.select(*series, "day", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"))


def _middle(ordered: Column) -> Column:
    """The median of a sorted array; NULL for an empty one."""
    n = F.size(ordered)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)).cast("double") / 2


def weekly_completeness(
    counts: DataFrame, series: Sequence[str], weeks: int = WEEKS, width: float = 3.0, floor: float = 0.1
) -> DataFrame:
    """Days that are unlike the same weekday of the trailing weeks, missing days among them.

    Expected is the median of the last ``weeks`` equal weekdays, and the spread their median
    deviation (times 1.4826, as for a normal spread), but ``floor`` of the expected at least. A busy
    Friday raises no alarm, a Monday without rows does, and neither moves the baseline as a mean
    would. The frame is one row per (series, day), so a window holds one series' weekday.
    """
    weekday = F.dayofweek("day")
    w = Window.partitionBy(*series, weekday).orderBy("day").rowsBetween(-weeks, -1)
    past = every_day(counts, series).withColumn("_past", F.array_sort(F.collect_list("rows").over(w)))
    past = past.withColumn("expected", _middle(F.col("_past")))
    away = F.array_sort(F.transform("_past", lambda x: F.abs(x - F.col("expected"))))
    spread = F.greatest(_middle(away) * F.lit(1.4826), F.col("expected") * F.lit(floor))
    off = F.abs(F.col("rows") - F.col("expected")) > F.lit(width) * F.col("spread")
    judged = past.withColumn("spread", spread).withColumn(
        "anomaly", F.coalesce((F.size("_past") >= MIN_WEEKS) & off, F.lit(False))
    )
    return judged.drop("_past")


def null_rates(df: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """Rows (day, column_name, nulls, rows) from one aggregate pass over the table."""
    summed = df.groupBy(day.alias("day")).agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return summed.unpivot(["day", "rows"], list(columns), "column_name", "nulls")


def null_rate_anomalies(
    rates: DataFrame, history: int = HISTORY, tolerance: float = 0.05
) -> DataFrame:
    """Days whose null share moves away from the share of the trailing days."""
    w = _trailing(["column_name"], history)
    share = F.try_divide(F.col("nulls").cast("double"), F.col("rows").cast("double"))
    usual = F.try_divide(F.sum("nulls").over(w).cast("double"), F.sum("rows").over(w).cast("double"))
    days = F.count("rows").over(w)
    return (
        rates.withColumns({"null_rate": share, "usual_rate": usual, "_n": days})
        .withColumn(
            "anomaly",
            F.coalesce(
                (F.col("_n") >= MIN_HISTORY) & (F.abs(F.col("null_rate") - F.col("usual_rate")) > tolerance),
                F.lit(False),
            ),
        )
        .drop("_n")
    )


def freshness(loads: DataFrame, series: Sequence[str], width: float = 3.0) -> DataFrame:
    """Late loads: the gap to the load before exceeds median + width * MAD of the series.

    ``loads`` has one row per load with a bigint ``loaded_at`` in seconds.
    """
    order = Window.partitionBy(*series).orderBy("loaded_at")
    gaps = loads.withColumn("gap", F.col("loaded_at") - F.lag("loaded_at").over(order)).filter("gap IS NOT NULL")
    middle = gaps.groupBy(*series).agg(F.percentile("gap", 0.5).alias("median_gap"))
    spread = (
        gaps.join(middle, list(series))
        .withColumn("_d", F.abs(F.col("gap") - F.col("median_gap")))
        .groupBy(*series)
        .agg(F.percentile("_d", 0.5).alias("mad"))
    )
    return (
        gaps.join(middle, list(series))
        .join(spread, list(series))
        .withColumn("late", F.col("gap") > F.col("median_gap") + F.lit(width) * F.col("mad"))
    )

"""Month and weekday factors of a daily series, fitted together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTHS, WEEKDAYS, ROUNDS = 12, 7, 30


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def seasonal_factors(daily: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, part, days, factor``: twelve month factors and seven weekday factors of ``day, amount``.

    A day is expected at the overall mean times its month's factor times its weekday's (1 = Sunday).
    Means per month alone would count a month's weekdays twice, since months hold unlike numbers of
    them. So both tables are fitted by turns, iterative proportional fitting: each round scales the
    months until their totals are met under the weekdays' factors, and then the weekdays. The month
    factors average 1 over all days. The table is summed up to 84 cells in one pass; the rounds are
    array expressions over these cells, in one row. Months or weekdays without days have no row.
    """
    cells = (
        daily.groupBy(F.month("day").alias("month"), F.dayofweek("day").alias("weekday"))
        .agg(F.count("*").cast("double").alias("n"), F.sum("amount").cast("double").alias("y"))
        .select(((F.col("month") - 1) * WEEKDAYS + F.col("weekday")).alias("cell"), "n", "y")
    )
    by_cell = F.map_from_entries(F.collect_list(F.struct("cell", F.struct("n", "y"))))
    totals = cells.agg(by_cell.alias("cells"), (F.sum("y") / F.sum("n")).alias("mean")).filter("mean <> 0")

    def grid(what: str) -> Column:
        """Months by weekdays; cells without days hold zero."""
        at = lambda i, j: F.coalesce(F.try_element_at("cells", (i * WEEKDAYS + j).cast("int")).getField(what), F.lit(0.0))
        weekdays = lambda i: F.transform(F.sequence(F.lit(1), F.lit(WEEKDAYS)), lambda j: at(i, j))
        return F.transform(F.sequence(F.lit(0), F.lit(MONTHS - 1)), weekdays)

    turned = lambda rows: F.transform(
        F.sequence(F.lit(1), F.lit(WEEKDAYS)), lambda j: F.transform(rows, lambda r: F.element_at(r, j))
    )
    added = lambda rows: F.transform(rows, lambda r: F.aggregate(r, F.lit(0.0), lambda s, x: s + x))

    def scaled(n: str, y: str, other: Column) -> Column:
        """What brings the totals ``y`` under the other factors; 1 where there are no days."""
        factor = lambda days, amount: F.coalesce(F.try_divide(amount, F.col("mean") * _dot(days, other)), F.lit(1.0))
        return F.zip_with(n, y, factor)

    table = totals.withColumns({"n": grid("n"), "y": grid("y")})
    table = table.withColumns({"n_turned": turned(F.col("n")), "y_turned": turned(F.col("y"))})
    table = table.withColumns(
        {
            "month_n": added(F.col("n")),
            "month_y": added(F.col("y")),
            "weekday_n": added(F.col("n_turned")),
            "weekday_y": added(F.col("y_turned")),
        }
    )
    ones = F.array_repeat(F.lit(1.0), WEEKDAYS)
    weekdays = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        ones,
        lambda w, _: scaled("n_turned", "weekday_y", scaled("n", "month_y", w)),
    )
    table = table.withColumn("weekdays", weekdays).withColumn("months", scaled("n", "month_y", F.col("weekdays")))
    level = _dot(F.col("months"), F.col("month_n")) / F.aggregate("month_n", F.lit(0.0), lambda s, x: s + x)
    table = table.withColumn("level", level)

    def listed(kind: str, factors: Column, days: str) -> Column:
        row = lambda f, i: F.struct(
            F.lit(kind).alias("kind"),
            (i + 1).alias("part"),
            F.element_at(days, i + 1).cast("bigint").alias("days"),
            f.alias("factor"),
        )
        return F.transform(factors, row)

    months = F.transform("months", lambda f: f / F.col("level"))
    week = F.transform("weekdays", lambda f: f * F.col("level"))
    rows = F.concat(listed("month", months, "month_n"), listed("weekday", week, "weekday_n"))
    return table.select(F.inline(rows)).filter("days > 0")

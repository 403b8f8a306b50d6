"""Forecasts of the country series: a trend-and-season baseline, and random forests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.calendar import calendar_columns
from oreflow.operators.joins import future_days, grid
from oreflow.operators.leaves import leaf_means, predict_by_leaves

HORIZON = 90
BAND = 1.28  # Fixed value: the two-sided 80% band of a normal residual.
CALENDAR_NUMBERS = ["trend", "sin_year", "cos_year", "weekday", "month", "month_day"]


def forecast_grid(series: DataFrame, days: int = HORIZON) -> DataFrame:
    """The ``days`` days after the series, for every country."""
    last = series.agg(F.max("day").alias("last"))
    ahead = last.select(F.explode(future_days(F.col("last"), days)).alias("day"))
    return grid(ahead, series.select("country"), "country")


def with_calendar(df: DataFrame, origin: Column) -> DataFrame:
    return df.withColumns(calendar_columns(F.col("day"), origin))


def seasonal_fit(series: DataFrame, measure: str, origin: Column) -> tuple[DataFrame, DataFrame]:
    """Least-squares trend per country, and the month's share of the country mean.

    All sums are exact decimals, so the fit does not depend on the order of rows.
    """
    t = F.datediff("day", origin).cast("decimal(18,0)")
    y = F.col(measure).cast("decimal(18,2)")
    points = series.select("country", F.month("day").alias("month"), t.alias("t"), y.alias("y"))
    sums = points.groupBy("country").agg(
        F.count("*").cast("double").alias("n"),
        F.sum("t").cast("double").alias("st"),
        F.sum(F.col("t") * F.col("t")).cast("double").alias("stt"),
        F.sum("y").cast("double").alias("sy"),
        F.sum((F.col("t") * F.col("y")).cast("decimal(38,2)")).cast("double").alias("sty"),
    )
    n, st, stt, sy, sty = (F.col(c) for c in ("n", "st", "stt", "sy", "sty"))
    slope = F.coalesce(F.try_divide(n * sty - st * sy, n * stt - st * st), F.lit(0.0))
    trend = sums.withColumn("slope", slope).select(
        "country", "slope", ((sy - F.col("slope") * st) / n).alias("level"), (sy / n).alias("mean")
    )
    months = points.groupBy("country", "month").agg(
        (F.sum("y").cast("double") / F.count("*").cast("double")).alias("month_mean")
    )
    season = months.join(trend.select("country", "mean"), "country").select(
        "country", "month", F.try_divide("month_mean", "mean").alias("season")
    )
    return trend.drop("mean"), season


def seasonal_predict(days: DataFrame, fit: tuple[DataFrame, DataFrame], name: str, origin: Column, digits: int) -> DataFrame:
    trend, season = fit
    value = (F.col("level") + F.col("slope") * F.datediff("day", origin)) * F.coalesce("season", F.lit(1.0))
    return (
        days.withColumn("month", F.month("day"))
        .join(trend, "country")
        .join(season, ["country", "month"], "left")
        .withColumn(name, F.round(F.greatest(value, F.lit(0.0)), digits))
        .drop("month", "level", "slope", "season")
    )


def seasonal_baseline(series: DataFrame, days: int = HORIZON) -> DataFrame:
    """Amount and units for the coming days: trend times season, never negative."""
    origin = series.agg(F.min("day")).scalar()
    future = forecast_grid(series, days)
    for measure, digits in (("amount", 2), ("units", 0)):
        fit = seasonal_fit(series, measure, origin)
        future = seasonal_predict(future, fit, f"{measure}_forecast", origin, digits)
    return future


def baseline_backtest(split: DataFrame, measure: str) -> DataFrame:
    """Fit on ``train`` rows and predict the ``test`` rows."""
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    origin = train.agg(F.min("day")).scalar()
    return seasonal_predict(test, seasonal_fit(train, measure, origin), "predicted", origin, 2)


def forest_forecast(future: DataFrame, amount: PipelineModel, units: PipelineModel, residual_sd: float) -> DataFrame:
    """Forecast with a band. Only the lower bound and the centre are cut at zero."""
    scored = units.transform(amount.transform(future).drop("features", "country_index", "country_hot"))
    return banded(scored, residual_sd)


def banded(scored: DataFrame, residual_sd: float) -> DataFrame:
    """The forecast columns from the predictions of both targets."""
    centre = F.col("amount_predicted")
    return scored.select(
        "day",
        "country",
        F.round(F.greatest(centre, F.lit(0.0)), 2).alias("amount_forecast"),
        F.round(F.greatest(centre - BAND * residual_sd, F.lit(0.0)), 2).alias("amount_min"),
        F.round(centre + BAND * residual_sd, 2).alias("amount_max"),
        F.round(F.greatest(F.col("units_predicted"), F.lit(0.0)), 0).alias("units_forecast"),
    )


def shared_forest_forecast(future: DataFrame, amount: PipelineModel, train: DataFrame, residual_sd: float) -> DataFrame:
    """The same from one forest: units come from the leaves of the amount's trees."""
    means = leaf_means(amount, train, ["amount", "units"])
    return banded(predict_by_leaves(amount, means, future, ["day", "country"], ["amount", "units"]), residual_sd)


def history_union_forecast(series: DataFrame, forecast: DataFrame) -> DataFrame:
    """One time line: actual amounts, then forecast amounts, NULL where the other speaks."""
    past = series.groupBy("day").agg(F.sum("amount").cast("double").alias("amount"))
    ahead = forecast.groupBy("day").agg(exact_sum("amount_forecast").alias("amount_forecast"))
    return past.unionByName(ahead, allowMissingColumns=True)


def actual_vs_forecast(series: DataFrame, forecast: DataFrame) -> DataFrame:
    return series.select("day", "country", F.col("amount").cast("double").alias("amount")).join(
        forecast.select("day", "country", "amount_forecast"), ["day", "country"], "full"
    )


def future_only(forecast: DataFrame, history: DataFrame) -> DataFrame:
    """Forecast rows after the last day of the history."""
    return forecast.filter(F.col("day") > history.agg(F.max("day")).scalar())


def country_forecast(forecast: DataFrame, country: str) -> DataFrame:
    """The forecast days of one country in order; the filter reaches the forecast's own scan."""
    return forecast.filter(F.col("country") == country).drop("country").orderBy("day")


def forecast_by_country(forecast: DataFrame) -> DataFrame:
    return (
        forecast.groupBy("country")
        .agg(
            F.round(exact_sum("amount_forecast"), 0).alias("amount_90d"),
            F.round(exact_sum("units_forecast"), 0).alias("units_90d"),
        )
        .orderBy(F.desc("amount_90d"), "country")
    )


def exact_sum(column: str) -> Column:
    """The sum of doubles that carry two decimals, through decimals."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")

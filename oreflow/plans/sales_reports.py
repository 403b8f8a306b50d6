"""Sales reports over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.money import cents
from oreflow.functions.bands import restock_band
from oreflow.functions.calendar import month_of, quarter_of
from oreflow.operators.dedupe import top_per_group
from oreflow.operators.ordered import extreme_share
from oreflow.plans.sales import ratio

# Fixed values of the star-product definition and of the restock screen.
STAR_SHARE, STAR_MARGIN = 0.10, 0.35
LOW_SHARE = 0.10
COVER_DAYS = 30


def totals(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Re-aggregate the daily table to coarser keys."""
    return df.groupBy(*keys).agg(
        F.sum("amount").alias("amount"), F.sum("units").alias("units"), F.sum("profit").alias("profit")
    )


def monthly_sales(daily: DataFrame) -> DataFrame:
    return totals(daily, [month_of(F.col("day")).alias("month")]).orderBy("month")


def weekday_profile(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.date_format("day", "E").alias("weekday")).agg(
        F.sum("amount").alias("amount"), F.sum("lines").alias("lines")
    )


def country_daily_series(daily: DataFrame) -> DataFrame:
    return daily.groupBy("day", "country").agg(F.sum("amount").alias("amount"), F.sum("units").alias("units"))


def kpi_retail_totals(daily: DataFrame, inventory: DataFrame) -> DataFrame:
    restock = inventory.agg(F.count_if("needs_restock")).scalar()
    return daily.agg(
        F.sum("amount").alias("amount"),
        F.sum("profit").alias("profit"),
        F.sum("units").alias("units"),
        F.sum("lines").alias("lines"),
    ).withColumn("products_to_restock", restock)


def top_products(products: DataFrame, n: int = 20) -> DataFrame:
    return products.orderBy(F.desc("total_amount"), "product_id").limit(n)


def star_products(products: DataFrame, share: float = STAR_SHARE, margin: float = STAR_MARGIN) -> DataFrame:
    """Among the top tenth by amount, and with a margin above the limit."""
    ranked = products.withColumn("_cents", cents(F.col("total_amount")))
    return extreme_share(ranked, "_cents", share, largest=True).filter(F.col("margin_pct") > margin).drop("_cents")


def star_products_example(products: DataFrame, margin: float = STAR_MARGIN, n: int = 20) -> DataFrame:
    """The short form of the question: margin only, first rows by amount."""
    return top_products(products.filter(F.col("margin_pct") > margin), n)


def low_performers(products: DataFrame, share: float = LOW_SHARE) -> DataFrame:
    ranked = products.withColumn("_cents", cents(F.col("total_amount")))
    return extreme_share(ranked, "_cents", share, largest=False).drop("_cents")


def top_margin_products(products: DataFrame, n: int = 10) -> DataFrame:
    return products.orderBy(F.desc("margin_pct"), "product_id").limit(n)


def margin_by(df: DataFrame, key: str, amount: str, profit: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.sum(amount).alias("amount"), F.sum(profit).alias("profit"))
        .withColumn("margin_pct", ratio("profit", "amount", 4))
    )


def quarter_growth(daily: DataFrame) -> DataFrame:
    """Amount per category and quarter against the quarter before."""
    per_quarter = daily.groupBy("category", quarter_of(F.col("day")).alias("quarter")).agg(
        F.sum("amount").alias("amount")
    )
    before = Window.partitionBy("category").orderBy("quarter")
    return per_quarter.withColumn("previous_amount", F.lag("amount").over(before)).withColumn(
        "growth", ratio(F.col("amount") - F.col("previous_amount"), "previous_amount", 4)
    )


def top_category_per_country(daily: DataFrame, n: int = 3) -> DataFrame:
    per = daily.groupBy("country", "category").agg(F.sum("amount").alias("amount"))
    return top_per_group(per, ["country"], [F.desc("amount"), F.col("category")], n)


def top_category_last_quarter(daily: DataFrame, as_of: Column) -> DataFrame:
    """The best category of the quarter that ``as_of`` lies in."""
    return (
        daily.filter((F.col("day") >= quarter_of(as_of)) & (F.col("day") <= as_of))
        .groupBy("category")
        .agg(F.sum("amount").alias("amount"))
        .orderBy(F.desc("amount"), "category")
        .limit(1)
    )


def filtered(
    daily: DataFrame,
    country: str | None = None,
    category: str | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Dashboard parameters; None means no restriction. Values travel as literals, not as text."""
    for column, value in (("country", country), ("category", category)):
        if value is not None:
            daily = daily.filter(F.col(column) == value)
    if first is not None:
        daily = daily.filter(F.col("day") >= F.lit(first))
    if last is not None:
        daily = daily.filter(F.col("day") <= F.lit(last))
    return daily


# -- inventory -----------------------------------------------------------------------------------


def restock_counts(status: DataFrame) -> DataFrame:
    return status.filter("needs_restock").groupBy("category", "country").agg(F.count("*").alias("products_to_restock"))


def kpi_restock(status: DataFrame, country: str, urgent_days: float = 7) -> DataFrame:
    needed = F.col("needs_restock")
    return status.filter(F.col("country") == country).agg(
        F.count("*").alias("products"),
        F.count_if(needed).alias("to_restock"),
        F.count_if(needed & (F.col("coverage_days") < urgent_days)).alias("urgent"),
    )


def restock_list(status: DataFrame, country: str) -> DataFrame:
    return (
        status.filter((F.col("country") == country) & F.col("needs_restock"))
        .withColumn("band", restock_band(F.col("coverage_days")))
        .orderBy(F.asc_nulls_first("coverage_days"), "product_id")
    )


def purchase_quantity(status: DataFrame, days: int = COVER_DAYS) -> DataFrame:
    """Units to buy so that the stock lasts ``days`` days."""
    wanted = F.ceil(F.lit(float(days)) * F.col("daily_demand") - F.col("stock_now"))
    return status.filter("needs_restock").select(
        "product_id", "country", "stock_now", "daily_demand", F.greatest(F.lit(0), wanted).cast("bigint").alias("buy")
    )


def stockout_risk(status: DataFrame) -> DataFrame:
    return status.filter(F.col("coverage_days") < F.col("lead_time_days"))

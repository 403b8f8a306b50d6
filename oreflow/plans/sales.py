"""Sales: raw lines to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.calendar import day_of, parse_timestamp
from oreflow.functions.money import MONEY
from oreflow.operators.dedupe import dedupe_by_key
from oreflow.operators.quality import DROP, WARN, Rule, apply_rules

SALES_RULES = (
    Rule("id_valid", "sale_id IS NOT NULL", DROP),
    Rule("quantity_positive", "quantity > 0", DROP),
    Rule("amount_positive", "amount > 0", WARN),
)
SILVER_COLUMNS = [
    "sale_id",
    "sold_at",
    "product_id",
    "product_name",
    "category",
    "brand",
    "country",
    "channel",
    "quantity",
    "unit_price",
    "discount_pct",
    "amount",
    "unit_cost",
    "profit",
]
DEMAND_DAYS = 90

# All line columns: a total order over the copies of a sale.
SALE_ORDER = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
# The two parts of a sale id.
SALE_KEY = ["l_orderkey", "l_linenumber"]


def unique_sales(raw: DataFrame) -> DataFrame:
    """One line per sale; the two id parts stand for ``sale_id``."""
    return dedupe_by_key(raw, SALE_KEY, SALE_ORDER).drop(*SALE_KEY, *SALE_ORDER)


def refine_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Enrich, type, derive and project; the same for a batch and for a stream."""
    cost = (F.col("quantity") * F.col("unit_cost")).cast(MONEY)
    extra = [c for c in lines.columns if c.startswith("_")]
    return (
        lines.join(products.drop("list_price"), "product_id", "left")
        .withColumn("sold_at", parse_timestamp(F.col("sold_at")))
        .withColumn("profit", (F.col("amount") - cost).cast(MONEY))
        .select(*SILVER_COLUMNS, *extra)
    )


def silver_sales(unique: DataFrame, products: DataFrame, rules: Sequence[Rule] = SALES_RULES) -> DataFrame:
    """Deduped lines to silver. The rules see the enriched output, so a bad survivor is dropped
    even when one of its copies was good."""
    return apply_rules(refine_sales(unique, products), rules)


def gold_daily_sales(silver: DataFrame) -> DataFrame:
    return silver.groupBy(day_of(F.col("sold_at")).alias("day"), "country", "category").agg(
        F.sum("quantity").alias("units"),
        F.sum("amount").alias("amount"),
        F.sum("profit").alias("profit"),
        F.count("*").alias("lines"),
    )


def ratio(numerator: str | Column, denominator: str | Column, digits: int) -> Column:
    """A rounded ratio of doubles; NULL over zero. Decimals are never divided."""
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.round(F.try_divide(n.cast("double"), d.cast("double")), digits)


def gold_product_sales(silver: DataFrame) -> DataFrame:
    """Totals per product, with the number of countries that sold it.

    Counting per (product, country) first keeps the distinct count a plain count.
    """
    product = ["product_id", "product_name", "category", "brand"]
    per_country = silver.groupBy(*product, "country").agg(
        F.sum("quantity").alias("units"), F.sum("amount").alias("amount"), F.sum("profit").alias("profit")
    )
    return (
        per_country.groupBy(*product)
        .agg(
            F.sum("units").alias("units_sold"),
            F.sum("amount").alias("total_amount"),
            F.sum("profit").alias("total_profit"),
            F.count("country").alias("countries_sold"),
        )
        .withColumn("margin_pct", ratio("total_profit", "total_amount", 4))
    )


def recent_demand(silver: DataFrame, as_of: Column, days: int = DEMAND_DAYS) -> DataFrame:
    """Units per day over the last ``days`` days; the divisor is the constant, not the days sold."""
    return (
        silver.filter(F.col("sold_at") >= F.date_sub(as_of, days))
        .groupBy("product_id", "country")
        .agg(F.round(F.sum("quantity") / F.lit(float(days)), 2).alias("daily_demand"))
    )


def stock_coverage(stock: Column, per_day: Column) -> Column:
    """Days until the stock is sold, to a tenth; unknown when nothing sells."""
    return F.round(stock / F.when(per_day > 0, per_day), 1)


def restock_flag(stock: Column, least: Column, coverage: Column, lead_days: Column) -> Column:
    """Whether to order now: certain below the least stock, else whether it lasts until a delivery.

    Unknown (NULL) when the stock is up and its coverage is unknown.
    """
    return F.when(stock < least, True).otherwise(coverage < lead_days)


def inventory_status(inventory: DataFrame, demand: DataFrame, products: DataFrame) -> DataFrame:
    """The stock of every product and country with its demand, coverage and restock flag."""
    named = inventory.join(products.select("product_id", "product_name", "category"), "product_id", "left")
    per_day = F.coalesce(F.col("daily_demand"), F.lit(0.0))
    stock, lead = F.col("stock_now"), F.col("lead_time_days")
    lasts = stock_coverage(stock, per_day)
    described = ["product_id", "product_name", "category", "country", "stock_now", "stock_min"]
    return named.join(demand, ["product_id", "country"], "left").select(
        *described,
        per_day.alias("daily_demand"),
        lasts.alias("coverage_days"),
        "lead_time_days",
        restock_flag(stock, F.col("stock_min"), lasts, lead).alias("needs_restock"),
    )

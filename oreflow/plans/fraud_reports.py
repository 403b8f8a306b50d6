"""Fraud reports over silver transactions and the daily risk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.calendar import day_of
from oreflow.plans.sales import ratio

WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
NIGHT = (2, 5)


def kpi_fraud_totals(risk: DataFrame) -> DataFrame:
    return (
        risk.agg(
            F.sum("transactions").alias("transactions"),
            F.sum("frauds").alias("frauds"),
            F.sum("fraud_amount").alias("fraud_amount"),
        )
        .withColumn("fraud_rate", ratio("frauds", "transactions", 6))
    )


def overall_rate(risk: DataFrame) -> DataFrame:
    """Frauds over transactions, of the whole table."""
    return risk.agg(ratio(F.sum("frauds"), F.sum("transactions"), 6).alias("overall_rate"))


def avg_of_rates(risk: DataFrame) -> DataFrame:
    """The unweighted mean of the daily rates; rates have four decimals, so the sum is exact."""
    exact = F.sum(F.col("fraud_rate").cast("decimal(10,4)"))
    return risk.agg(ratio(exact, F.count("fraud_rate"), 6).alias("avg_of_rates"))


def top_fraud_categories(risk: DataFrame, n: int = 10) -> DataFrame:
    return (
        risk.groupBy("merchant_category")
        .agg(F.sum("frauds").alias("frauds"))
        .orderBy(F.desc("frauds"), "merchant_category")
        .limit(n)
    )


def top_fraud_amount(risk: DataFrame, n: int = 5) -> DataFrame:
    return (
        risk.groupBy("merchant_category")
        .agg(F.sum("fraud_amount").alias("fraud_amount"))
        .orderBy(F.desc("fraud_amount"), "merchant_category")
        .limit(n)
    )


def fraud_amount_by_day(risk: DataFrame) -> DataFrame:
    return risk.groupBy("day").agg(F.sum("fraud_amount").alias("fraud_amount")).orderBy("day")


def top_fraud_days(risk: DataFrame, n: int = 20) -> DataFrame:
    """The rows of the daily table with the largest fraud amount."""
    return risk.orderBy(F.desc("fraud_amount"), "day", "region", "merchant_category").limit(n)


def cumulative_fraud(risk: DataFrame) -> DataFrame:
    """Running fraud amount; the window runs over one row per day."""
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    daily = risk.groupBy("day").agg(F.sum("fraud_amount").alias("fraud_amount"))
    return daily.withColumn("cumulative_amount", F.sum("fraud_amount").over(so_far))


def fraud_heatmap(silver: DataFrame) -> DataFrame:
    """Frauds per region (rows) and weekday (columns)."""
    frauds = silver.select("region", F.date_format("occurred_at", "E").alias("weekday"), "is_fraud")
    return frauds.groupBy("region").pivot("weekday", WEEKDAYS).agg(F.count_if("is_fraud"))


def fraud_rate_by(silver: DataFrame, key: Column) -> DataFrame:
    return (
        silver.groupBy(key)
        .agg(F.count("*").alias("transactions"), F.count_if("is_fraud").alias("frauds"))
        .withColumn("fraud_rate_pct", F.round(F.try_divide(F.col("frauds") * 100.0, F.col("transactions").cast("double")), 4))
    )


def night_fraud_channel(silver: DataFrame) -> DataFrame:
    """The channel with the highest fraud rate at night."""
    night = silver.filter(F.hour("occurred_at").between(*NIGHT))
    return fraud_rate_by(night, F.col("channel")).orderBy(F.desc("fraud_rate_pct"), "channel").limit(1)


def amount_at_risk(suspicious: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Count and amount of suspicious transactions of the last ``days`` days."""
    recent = suspicious.filter(day_of(F.col("occurred_at")) > F.date_sub(as_of, days))
    return recent.agg(F.count("*").alias("transactions"), F.sum("amount").alias("amount_at_risk"))


def anomalous_customers(silver: DataFrame, width: float = 2.0) -> DataFrame:
    """Customers whose total lies more than ``width`` deviations above the mean of customers."""
    per = silver.groupBy("customer_id").agg(F.count("*").alias("transactions"), F.sum("amount").alias("total"))
    total = F.col("total").cast("decimal(18,2)")
    stats = per.agg(
        F.struct(
            F.count("*").cast("double").alias("n"),
            F.sum(total).cast("double").alias("s"),
            F.sum((total * total).cast("decimal(38,4)")).cast("double").alias("q"),
        )
    ).scalar()
    known = per.withColumn("_t", stats)
    n, s, q = (F.col(f"_t.{c}") for c in "nsq")
    mean = F.try_divide(s, n)
    sd = F.sqrt(F.try_divide(q * n - s * s, n * (n - 1)))
    z = F.round(F.try_divide(F.col("total").cast("double") - mean, sd), 4)
    return known.withColumn("z_score", z).filter(F.col("z_score") > width).drop("_t")

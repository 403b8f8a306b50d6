"""Card fraud: raw transactions to silver, gold, features and suspicion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.calendar import day_of, parse_timestamp
from oreflow.functions.money import mean_of
from oreflow.operators.dedupe import dedupe_by_key
from oreflow.operators.quality import DROP, WARN, Rule, apply_rules
from oreflow.operators.scoring import weighted_score
from oreflow.plans.sales import ratio

TX_RULES = (
    Rule("id_valid", "tx_id IS NOT NULL", DROP),
    Rule("amount_positive", "amount > 0", DROP),
    Rule("currency_known", "currency IN ('COP','USD')", WARN),
    Rule("amount_reasonable", "amount < 1000000", WARN),
)
SILVER_COLUMNS = [
    "tx_id",
    "customer_id",
    "card_number",
    "amount",
    "currency",
    "merchant_category",
    "channel",
    "country",
    "region",
    "occurred_at",
    "is_fraud",
    "segment",
    "tenure_months",
    "credit_score",
]
CATEGORY_FEATURES = ["merchant_category", "channel", "segment"]
NUMBER_FEATURES = ["amount", "amount_deviation", "hour", "is_foreign", "tenure_months", "credit_score"]
SUSPICIOUS_FACTOR = 3

# The home country, and the points of each signal.
HOME_COUNTRY = "CO"
RISK_RULES = (
    (f"country <> '{HOME_COUNTRY}'", 2.5),
    ("cast(substring(occurred_at, 12, 2) as int) between 2 and 5", 2.0),
    ("channel = 'online'", 1.2),
    ("channel = 'atm'", 0.8),
)
SCORE_SCALE = 1_000_000


def risk_points() -> Column:
    """Points for the signals that do not depend on the amount, in millionths."""
    return weighted_score(RISK_RULES, SCORE_SCALE)


def risk_score(amount: Column, category_mean: Column) -> Column:
    """The amount over its category's mean, plus the signals' points; in millionths."""
    relative = (amount.cast("double") / category_mean).cast("decimal(18,6)")
    return (relative * SCORE_SCALE).cast("bigint") + risk_points()


def refine_transactions(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Enrich, type and project. The transaction has its own region, so the customer's goes."""
    extra = [c for c in tx.columns if c.startswith("_")]
    return (
        tx.join(customers.drop("region"), "customer_id", "left")
        .withColumn("occurred_at", parse_timestamp(F.col("occurred_at")))
        .select(*SILVER_COLUMNS, *extra)
    )


def silver_transactions(raw: DataFrame, customers: DataFrame, rules: Sequence[Rule] = TX_RULES) -> DataFrame:
    order = [c for c in raw.columns if c != "tx_id"]
    return apply_rules(refine_transactions(dedupe_by_key(raw, ["tx_id"], order), customers), rules)


def gold_daily_risk(silver: DataFrame) -> DataFrame:
    """Counts, amounts and rates per day, region and category; ratios use the rounded totals."""
    fraud_amount = F.sum(F.when(F.col("is_fraud"), F.col("amount")).otherwise(0))
    return (
        silver.groupBy(day_of(F.col("occurred_at")).alias("day"), "region", "merchant_category")
        .agg(
            F.count("*").alias("transactions"),
            F.round(F.sum("amount"), 0).cast("double").alias("total_amount"),
            F.count_if("is_fraud").alias("frauds"),
            F.round(fraud_amount, 0).cast("double").alias("fraud_amount"),
        )
        .withColumn("fraud_rate", ratio("frauds", "transactions", 4))
        .withColumn("average_ticket", ratio("total_amount", "transactions", 0))
    )


def category_means(silver: DataFrame) -> DataFrame:
    """Mean amount per merchant category: kept as a table, used by training and by scoring."""
    return silver.groupBy("merchant_category").agg(mean_of(F.col("amount")).alias("category_mean"))


def with_deviation(silver: DataFrame, means: DataFrame) -> DataFrame:
    """Amount over its category's mean. A join with the means, since a window over the category
    would put a dominant category into one task."""
    return silver.join(means, "merchant_category", "left").withColumn(
        "amount_deviation", F.try_divide(F.col("amount").cast("double"), F.col("category_mean"))
    )


def fraud_features(silver: DataFrame, means: DataFrame, label: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Model columns, numbers as doubles; rows with any NULL are dropped."""
    out = with_deviation(silver, means).select(
        *keep,
        F.col("amount").cast("double").alias("amount"),
        "amount_deviation",
        F.hour("occurred_at").cast("double").alias("hour"),
        (F.col("country") != HOME_COUNTRY).cast("double").alias("is_foreign"),
        *CATEGORY_FEATURES,
        F.col("tenure_months").cast("double").alias("tenure_months"),
        F.col("credit_score").cast("double").alias("credit_score"),
        *([F.col("is_fraud").cast("int").alias("is_fraud")] if label else []),
    )
    return out.na.drop()


def suspicious(silver: DataFrame, means: DataFrame, factor: float = SUSPICIOUS_FACTOR) -> DataFrame:
    """Amount above ``factor`` times the category mean, or abroad."""
    high = F.col("amount").cast("double") > F.lit(float(factor)) * F.col("category_mean")
    return silver.join(means, "merchant_category").filter(high | (F.col("country") != HOME_COUNTRY))


def this_week(df: DataFrame, as_of: Column) -> DataFrame:
    """The seven days that end with ``as_of``."""
    return df.filter(day_of(F.col("occurred_at")).between(F.date_sub(as_of, 6), as_of))

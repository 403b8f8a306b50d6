"""Gates between the pipeline and its consumers, and controls on raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.calendar import month_distance
from oreflow.operators.quality import check_rows

# The ranges that the job accepts.
MIN_MONTHS = 12
FRAUD_RATE_RANGE = (0.005, 0.05)
INVALID_SHARE_RANGE = (0.01, 0.03)
FRAUD_SHARE_RANGE = (0.01, 0.025)


def _share(part, whole):
    return F.round(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), 6)


def validate_retail(daily: DataFrame, status: DataFrame) -> DataFrame:
    """Gold is there, has money, covers a year, and knows what to restock."""
    restock = status.agg(F.count_if("needs_restock")).scalar()
    known = status.agg(F.count("needs_restock")).scalar()
    values = {
        "rows": F.count("*"),
        "amount": F.sum("amount"),
        "months": F.months_between(F.max("day"), F.min("day")),
        "restock": F.max(restock),
        "known": F.max(known),
    }
    checks = [
        ("rows_present", "rows", F.col("rows") > 0),
        ("amount_positive", "amount", F.col("amount") > 0),
        ("enough_months", "months", F.col("months") >= MIN_MONTHS),
        ("restock_known", "restock", F.col("known") > 0),
    ]
    return check_rows(daily, values, checks)


def validate_fraud(risk: DataFrame) -> DataFrame:
    values = {"rows": F.count("*"), "frauds": F.sum("frauds"), "transactions": F.sum("transactions")}
    low, high = FRAUD_RATE_RANGE
    rate = _share("frauds", "transactions")
    summed = risk.agg(*[c.alias(n) for n, c in values.items()]).withColumn("rate", rate)
    checks = [
        ("rows_present", "rows", F.col("rows") > 0),
        ("frauds_present", "frauds", F.col("frauds") > 0),
        ("rate_in_range", "rate", F.col("rate").between(low, high)),
    ]
    return check_rows(summed, {c: F.max(c) for c in ("rows", "frauds", "rate")}, checks)


def file_control_sales(raw: DataFrame, min_rows: int, countries: int, min_months: int) -> DataFrame:
    """One pass over the raw sales. The distinct countries come from a set of that short list."""
    day = F.to_date(F.substring("sold_at", 1, 10))
    summed = raw.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("product_id").isNull()).alias("null_keys"),
        F.count_if(F.col("quantity") <= 0).alias("invalid"),
        F.count_distinct("country").alias("countries"),
        month_distance(F.min(day), F.max(day)).alias("months"),
    ).withColumn("invalid_share", _share("invalid", "rows"))
    names = ["rows", "null_keys", "invalid_share", "countries", "months"]
    checks = [
        ("rows", "rows", F.col("rows") > min_rows),
        ("null_keys", "null_keys", F.col("null_keys") == 0),
        ("invalid_share", "invalid_share", F.col("invalid_share").between(*INVALID_SHARE_RANGE)),
        ("countries", "countries", F.col("countries") == countries),
        ("months", "months", F.col("months") >= min_months),
    ]
    return check_rows(summed, {c: F.max(c) for c in names}, checks)


def file_control_transactions(raw: DataFrame, min_rows: int, min_categories: int) -> DataFrame:
    summed = (
        raw.agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("customer_id").isNull()).alias("null_keys"),
            F.count_if("is_fraud").alias("frauds"),
            F.count_if(F.col("amount") <= 0).alias("invalid"),
            F.count_distinct("merchant_category").alias("categories"),
        )
        .withColumn("fraud_share", _share("frauds", "rows"))
        .withColumn("invalid_share", _share("invalid", "rows"))
    )
    names = ["rows", "null_keys", "fraud_share", "invalid_share", "categories"]
    checks = [
        ("rows", "rows", F.col("rows") > min_rows),
        ("null_keys", "null_keys", F.col("null_keys") == 0),
        ("fraud_share", "fraud_share", F.col("fraud_share").between(*FRAUD_SHARE_RANGE)),
        ("invalid_share", "invalid_share", F.col("invalid_share").between(*INVALID_SHARE_RANGE)),
        ("categories", "categories", F.col("categories") >= min_categories),
    ]
    return check_rows(summed, {c: F.max(c) for c in names}, checks)

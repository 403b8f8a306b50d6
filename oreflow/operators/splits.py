"""Deterministic splits of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.buckets import bucket
from oreflow.operators.ordered import exact_quantile


def time_split(df: DataFrame, day: str, test_days: int, last: Column | None = None) -> DataFrame:
    """Label the last ``test_days`` days ``test`` and everything before ``train``."""
    last = df.agg(F.max(day)).scalar() if last is None else last
    return df.withColumn("part", F.when(F.col(day) > F.date_sub(last, test_days), "test").otherwise("train"))


def stratified_split(df: DataFrame, key: Column, test_percent: int = 25) -> DataFrame:
    """Label a stable share of every stratum ``test``, by hash of the row key."""
    return df.withColumn("part", F.when(bucket(key, 100) < test_percent, "test").otherwise("train"))


def recency_split(df: DataFrame, day: str, share: float, last: Column) -> DataFrame:
    """Label about the newest ``share`` of the rows ``late``, by whole days."""
    aged = df.withColumn("_age", F.datediff(last, day).cast("bigint"))
    cut = exact_quantile(aged, "_age", share)
    return aged.withColumn("batch", F.when(F.col("_age") <= F.lit(cut), "late").otherwise("initial")).drop("_age")

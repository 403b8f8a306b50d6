"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key under a total order.

    The filter on ``row_number`` lets Spark cut every key to one row inside each map task before
    the shuffle, so a key with a third of all rows sends one row per task and not its whole group.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, cut before the shuffle in the same way."""
    ranked = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)

"""Grids and join controls. Plain joins are left to Spark, which picks the strategy by bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid(df: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Every row once per distinct value of a list (countries, say), by design.

    The list travels as one array value, so each row expands where it is and nothing shuffles.
    """
    listed = values.select(column).distinct().agg(F.sort_array(F.collect_set(column))).scalar()
    return df.withColumn(column, F.explode(listed))


def future_days(last: Column, days: int) -> Column:
    """An array of the ``days`` dates after ``last``."""
    return F.sequence(F.date_add(last, 1), F.date_add(last, days))


def orphans(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Fact rows that have no dimension row."""
    return fact.join(dim, on, "left_anti")


def join_loss(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """One row: rows before and after an inner join, and the share kept.

    Both sides are counted per key first, so a hot key is one row in the join.
    """
    per_key = fact.groupBy(on).agg(F.count("*").alias("_fact"))
    dim_key = dim.groupBy(on).agg(F.count("*").alias("_dim"))
    return (
        per_key.join(dim_key, on, "left")
        .agg(
            F.coalesce(F.sum("_fact"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum(F.col("_fact") * F.coalesce("_dim", F.lit(0))), F.lit(0)).alias("rows_after"),
        )
    )


def require_lossless(loss: DataFrame, keep: float = 0.99) -> DataFrame:
    """Fail the job when the join keeps less than ``keep`` of the rows."""
    bad = F.col("rows_after") < F.col("rows_before") * F.lit(keep)
    checked = F.when(
        bad, F.raise_error(F.concat(F.lit("join lost rows: "), "rows_before", F.lit(" -> "), "rows_after"))
    ).otherwise(F.col("rows_after"))
    return loss.withColumn("rows_after", checked.cast("bigint"))

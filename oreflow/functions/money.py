"""Money: exact decimals inside, doubles only at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def cents_to_money(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def cents(money: Column) -> Column:
    """Money as whole cents, for exact ranks."""
    return (money * 100).cast("bigint")


def mean_of(amount: Column) -> Column:
    """The mean of a decimal as a double, from an exact sum: the same on every run."""
    return F.sum(amount).cast("double") / F.count(amount).cast("double")


def money_out(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for reports that leave Spark."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )

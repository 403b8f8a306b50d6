"""Exact ranks and quantiles over a whole table without one big sort.

A global window would pull every row into one task. Here the rows are counted per distinct value
once, and ranks are then found by layers of the value's bits, highest bits first: no window ever
sees more than ``2 ** LAYER_BITS`` rows of a group, whatever the data look like. Values must be
non-negative ``bigint``: money in cents, scores in millionths, days.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAYER_BITS = 20


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """Rows per distinct value: the only pass over the table."""
    return df.select(F.col(value).alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("rows"))


def order_statistics(df: DataFrame, value: str, ranks: Callable[[int], Sequence[int]]) -> tuple[int, list[int | None]]:
    """The number of rows and the values at 0-based ranks; ``ranks`` gets the number of rows.

    Runs small jobs, as ``approxQuantile`` does; each brings one row per rank to the driver.
    """
    counts = value_counts(df, value).persist()
    try:
        n, low, top, distinct = counts.agg(F.sum("rows"), F.min("v"), F.max("v"), F.count("*")).first()
        if n is None:
            return 0, []
        if low < 0:
            raise ValueError(f"{value} must not be negative")
        wanted = list(ranks(n))
        if any(not 0 <= r < n for r in wanted):
            raise ValueError("rank outside the table")
        return n, _locate(counts, wanted, top.bit_length(), few=distinct <= 2**LAYER_BITS)
    finally:
        counts.unpersist()


def _locate(counts: DataFrame, wanted: Sequence[int], bits: int, few: bool) -> list[int]:
    """The value at each rank, one layer of bits after the other; one layer when values are few."""
    shift = max(1, math.ceil(bits / LAYER_BITS)) * LAYER_BITS
    # (rank inside the bucket, bucket) per wanted rank; at the start one bucket holds all rows.
    found = [(r, 0) for r in wanted]
    while shift > 0:
        parent, shift = shift, 0 if few else shift - LAYER_BITS
        buckets = sorted({b for _, b in found})
        layer = (
            counts.withColumn("parent", F.shiftright("v", parent) if parent < 64 else F.lit(0).cast("bigint"))
            .filter(F.col("parent").isin(buckets))
            .groupBy("parent", F.shiftright("v", shift).alias("bucket"))
            .agg(F.sum("rows").alias("rows"))
        )
        before = Window.partitionBy("parent").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        layer = layer.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        hit = F.lit(False)
        for r, b in found:
            inside = (F.col("before") <= r) & (F.lit(r) < F.col("before") + F.col("rows"))
            hit = hit | ((F.col("parent") == b) & inside)
        rows = layer.filter(hit).collect()
        found = [
            next(
                (r - row["before"], row["bucket"])
                for row in rows
                if row["parent"] == b and row["before"] <= r < row["before"] + row["rows"]
            )
            for r, b in found
        ]
    return [b for _, b in found]


def exact_quantile(df: DataFrame, value: str, p: float) -> float | None:
    """The linearly interpolated quantile, exact; NULLs are left out."""

    def around(n: int) -> list[int]:
        low = math.floor((n - 1) * p)
        return [low, min(low + 1, n - 1)]

    n, values = order_statistics(df, value, around)
    if n == 0:
        return None
    position = (n - 1) * p
    low, high = values
    return low + (position - math.floor(position)) * (high - low)


def extreme_share(df: DataFrame, value: str, share: float, largest: bool) -> DataFrame:
    """Rows whose rank by ``value`` is within the given share of all rows; ties stay together."""

    def edge(n: int) -> list[int]:
        wanted = max(1, math.ceil(round(n * share, 9)))
        return [n - wanted if largest else wanted - 1]

    n, cut = order_statistics(df, value, edge)
    if n == 0:
        return df.limit(0)
    return df.filter(F.col(value) >= cut[0] if largest else F.col(value) <= cut[0])

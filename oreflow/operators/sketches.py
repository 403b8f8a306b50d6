"""Quantiles that merge: a sketch per day and key once, any range of them later."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 400


def rank_error(k: int = SKETCH_K) -> float:
    """The error of a rank, as a share of the rows, that a sketch of size ``k`` keeps with 99 %.

    The figure that is published for this family of sketches, 2.446 / k ** 0.943.
    """
    return 2.446 / math.pow(k, 0.943)


def quantile_sketches(df: DataFrame, value: str, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``keys, n, sketch`` of a ``bigint`` column: one pass over the table, partial sketches per task.

    A sketch is some kilobytes, whatever its group's rows, so a group with most rows is no hot task.
    NULLs are left out; a group of them alone has ``n = 0``.
    """
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.kll_sketch_agg_bigint(value, k).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """The same for coarser keys, or for a range of days that was filtered before; no row is read again."""
    return (
        sketches.filter("n > 0")
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))
    )


def sketch_quantile(sketch: str | Column, p: float) -> Column:
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(p)))


def with_quantiles(sketches: DataFrame, ps: Sequence[float]) -> DataFrame:
    """Rows (keys, n, p, value), one per quantile."""
    keys = [c for c in sketches.columns if c not in ("n", "sketch")]
    rows = F.array(
        *[F.struct(F.lit(float(p)).alias("p"), sketch_quantile("sketch", p).alias("value")) for p in ps]
    )
    return sketches.select(*keys, "n", F.inline(rows))

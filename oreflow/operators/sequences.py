"""The next and the previous row of each key, also for keys that hold a large share of all rows.

``lead``/``lag`` over a key sends the whole key to one task. That is right for ordinary keys, which
cost one shuffle here. Keys with more than ``HOT_ROWS`` rows are cut into time buckets as well: the
windows run per (key, bucket), and only the first and last row of each bucket are carried across,
from a frame with one row per (key, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000


def _same(cells: Sequence[str]) -> Column:
    match = F.lit(True)
    for c in cells:
        match = match & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return match


def _within(df: DataFrame, cells: Sequence[str], order: Sequence[str], carried: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*cells).orderBy(*order)
    row = F.struct(*carried)
    return df.withColumns({"_p": F.lag(row).over(w), "_n": F.lead(row).over(w)})


def _bucketed(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], carried: Sequence[str]
) -> DataFrame:
    df = df.withColumn("_bucket", bucket)
    cells = [*keys, "_bucket"]
    row = F.struct(*carried)
    # The order columns come first in the row, so its minimum is the first row of the bucket.
    edges = df.groupBy(*cells).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_bucket")
    edges = edges.select(
        *cells,
        F.lag("_last").over(across).alias("_before"),
        F.lead("_first").over(across).alias("_after"),
    )
    inner = _within(df, cells, order, carried)
    joined = inner.alias("l").join(edges.alias("r"), _same(cells), "left").select("l.*", "r._before", "r._after")
    return joined.withColumns({"_p": F.coalesce("_p", "_before"), "_n": F.coalesce("_n", "_after")}).drop(
        "_bucket", "_before", "_after"
    )


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None. One counting job.

    At most ``rows / hot_rows`` keys can be hot, so the list is small whatever the table's size.
    """
    hot = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows).select(*keys)
    return None if hot.isEmpty() else hot


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    previous: Sequence[str] = (),
    following: Sequence[str] = (),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>``; ``order`` is total within a key, ``bucket`` grows with it.

    ``hot`` are the keys to cut into buckets, from ``hot_keys``.
    """
    carried = list(dict.fromkeys([*order, *previous, *following]))
    if hot is None:
        out = _within(df, keys, order, carried)
    else:
        hot = F.broadcast(hot).alias("r")
        cold = df.alias("l").join(hot, _same(keys), "left_anti")
        warm = df.alias("l").join(hot, _same(keys), "left_semi")
        out = _within(cold, keys, order, carried).unionByName(_bucketed(warm, keys, bucket, order, carried))
    out = out.withColumns(
        {
            **{f"prev_{c}": F.col("_p").getField(c) for c in previous},
            **{f"next_{c}": F.col("_n").getField(c) for c in following},
        }
    )
    return out.drop("_p", "_n")

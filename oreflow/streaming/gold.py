"""Gold that follows silver: only the days that a micro-batch touches are computed again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.sources.files import overwrite_partitions
from oreflow.streaming.buckets import drain_batches


def on_days(silver: DataFrame, day: str, days: list) -> DataFrame:
    """The rows of some days; ``day`` is a partition column, so the others' files are not opened."""
    known = [d for d in days if d is not None]
    wanted: Column = F.col(day).isin(known)
    return silver.filter(wanted | F.col(day).isNull() if None in days else wanted)


def refresh_days(
    spark: SparkSession,
    new_rows: DataFrame,
    summarise: Callable[[DataFrame], DataFrame],
    silver: str,
    gold: str,
    checkpoint: str,
    day: str = "day",
) -> None:
    """Bring a gold table per day up to date with the silver rows that ``new_rows`` streams.

    The driver learns the days of a batch, nothing else. Their rows are read from the whole silver
    table, old and new, pruned to these days; ``summarise`` is the same function that builds all of
    gold, and its result replaces the partitions of these days. So a late row corrects its day, and
    a replayed batch computes the same days to the same result.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        days = sorted((r[0] for r in batch.select(day).distinct().collect()), key=str)
        if days:
            rows = on_days(batch.sparkSession.read.parquet(silver), day, days)
            overwrite_partitions(summarise(rows.drop(day)), gold, day)

    drain_batches(new_rows, refresh, checkpoint)

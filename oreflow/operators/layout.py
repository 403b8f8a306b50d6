"""Physical layout of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Let the whole cluster work on a source that arrives in a few unsplittable pieces.

    A parquet file with one row group is one task, whatever its readers do next. Spark already
    plans at least one partition per core unless the table is smaller than 4 MB per core, so only
    such small tables are spread, and large ones never shuffle here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)

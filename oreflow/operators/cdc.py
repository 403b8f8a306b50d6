"""Change feeds: latest state per key (type 1) and full history per key (type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.operators.dedupe import dedupe_by_key
from oreflow.operators.sequences import HOT_ROWS, hot_keys, with_neighbours

MARK, SPAN_END = "_starts_span", "_span_end"


def scd1(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """The last change of each key; keys whose last change deletes them are gone."""
    latest = dedupe_by_key(changes, keys, [F.desc(c) for c in sequence])
    return latest if deleted is None else latest.filter(~F.coalesce(deleted, F.lit(False)))


def merge_scd1(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], deleted: Column | None = None
) -> DataFrame:
    """Apply a batch of changes to the current state: newest change wins, by the sequence."""
    both = current.unionByName(changes, allowMissingColumns=True)
    return scd1(both, keys, sequence, deleted)


def _marked(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    tracked: Sequence[str],
    bucket: Column,
    hot: DataFrame | None,
) -> DataFrame:
    """Every change, and whether it differs from the tracked state before it."""
    previous = [*tracked, sequence[0]]
    seen = with_neighbours(changes, keys, bucket, sequence, previous=previous, hot=hot)
    same = F.col(f"prev_{sequence[0]}").isNotNull()
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    return seen.withColumn(MARK, ~same).drop(*[f"prev_{c}" for c in previous])


def _ended(marked: DataFrame, keys: Sequence[str], sequence: Sequence[str], bucket: Column, hot: DataFrame | None) -> DataFrame:
    """The changes that start a span, with the start of the next one."""
    spans = with_neighbours(marked.filter(MARK), keys, bucket, sequence, following=[sequence[0]], hot=hot)
    return spans.withColumnRenamed(f"next_{sequence[0]}", SPAN_END)


def span_marks(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    tracked: Sequence[str],
    bucket: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every change, whether a span starts with it, and where that span ends."""
    hot = hot_keys(changes, keys, hot_rows)
    marked = _marked(changes, keys, sequence, tracked, bucket, hot)
    repeats = marked.filter(~F.col(MARK)).withColumn(SPAN_END, F.lit(None).cast(changes.schema[sequence[0]].dataType))
    return _ended(marked, keys, sequence, bucket, hot).unionByName(repeats)


def spans_of(marked: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """The spans among marked changes, under their public names."""
    return (
        marked.filter(MARK)
        .drop(MARK)
        .withColumnsRenamed({sequence[0]: "valid_from", SPAN_END: "valid_to"})
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    tracked: Sequence[str],
    bucket: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per span in which the tracked columns of a key stayed the same.

    Repeated states are merged first; ``valid_to`` is the start of the next span, NULL for the
    current one. ``sequence[0]`` is the time, ``bucket`` a coarse time such as its date.
    """
    hot = hot_keys(changes, keys, hot_rows)
    marked = _marked(changes, keys, sequence, tracked, bucket, hot)
    return spans_of(_ended(marked, keys, sequence, bucket, hot), sequence)

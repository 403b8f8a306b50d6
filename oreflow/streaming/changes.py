"""Change streams into tables: latest state per key (type 1), and history per key (type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.cdc import MARK, SPAN_END, scd1, span_marks, spans_of
from oreflow.operators.sequences import HOT_ROWS
from oreflow.session import materialise
from oreflow.streaming.buckets import BUCKETS, BucketedTable, drain_batches


def _table(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, buckets: int) -> BucketedTable:
    return BucketedTable(spark, path, tuple(keys), schema, buckets)


def _with_marks(schema: T.StructType, sequence: Sequence[str]) -> T.StructType:
    return T.StructType(
        [*schema.fields, T.StructField(MARK, T.BooleanType()), T.StructField(SPAN_END, schema[sequence[0]].dataType)]
    )


def run_scd1(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    checkpoint: str,
    deleted: Column | None = None,
    keep_deleted: str | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Keep one row per key under ``path``: its newest change by ``sequence``.

    The table is dealt to hash buckets of the key. A batch is first cut to its newest change per
    key, then merged with the stored rows of the buckets it touches, which it replaces; what it reads
    and writes grows with the keys that it meets and their buckets, not with the changes ever seen.
    A replayed batch changes nothing. Deleting changes stay as tombstones, so that an older change
    that arrives later cannot bring its key back. ``keep_deleted``, an interval such as ``30 days``
    over the first column of ``sequence``, lets tombstones go that are older than the newest change
    of their batch by more; an older change that arrives still later would then revive its key.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        latest = materialise(scd1(batch, keys, sequence), "changes")
        state = _table(batch.sparkSession, path, keys, stream.schema, buckets)
        touched = state.touched(latest)
        if not touched:
            return

        def merged() -> DataFrame:
            rows = scd1(state.read_buckets(touched).unionByName(latest), keys, sequence)
            if keep_deleted is None or deleted is None:
                return rows
            newest = latest.agg(F.max(sequence[0])).first()[0]
            old = F.col(sequence[0]) < F.lit(newest) - F.expr(f"interval {keep_deleted}")
            return rows.filter(~(F.coalesce(deleted, F.lit(False)) & old))

        state.replace(batch_id, merged)

    drain_batches(stream, merge, checkpoint)


def current_state(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    schema: T.StructType,
    deleted: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per key: its newest change, unless that change deletes it. A plain scan."""
    rows = _table(spark, path, keys, schema, buckets).read()
    return rows if deleted is None else rows.filter(~F.coalesce(deleted, F.lit(False)))


def run_scd2(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    tracked: Sequence[str],
    bucket: Column,
    checkpoint: str,
    hot_rows: int = HOT_ROWS,
    buckets: int = BUCKETS,
) -> None:
    """Keep the history of every key under ``path``, whatever the order in which changes arrive.

    The table holds every change with two marks: whether a span starts with it, and where that span
    ends. A late change is spliced in among them: it may split a span, start one earlier, or take
    away the start of the next. Changes that repeat the state before them are stored without a
    span, because a late one may fall between. Only buckets of the batch's keys are read and
    replaced, and in them only these keys' spans are found anew; the other rows are copied. A change
    with the key and sequence of a stored one is that change, so a replayed batch or a file that is
    delivered twice changes nothing.
    """

    def splice(batch: DataFrame, batch_id: int) -> None:
        changes = materialise(batch.dropDuplicates([*keys, *sequence]), "changes")
        state = _table(batch.sparkSession, path, keys, _with_marks(stream.schema, sequence), buckets)
        touched = state.touched(changes)
        if not touched:
            return

        def spliced() -> DataFrame:
            stored = state.read_buckets(touched).alias("s")
            met = changes.select(*keys).distinct().alias("m")
            same = [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
            both = stored.join(met, same, "left_semi").drop(MARK, SPAN_END).unionByName(changes)
            both = materialise(both.dropDuplicates([*keys, *sequence]), "spliced")
            return span_marks(both, keys, sequence, tracked, bucket, hot_rows).unionByName(
                stored.join(met, same, "left_anti")
            )

        state.replace(batch_id, spliced)

    drain_batches(stream, splice, checkpoint)


def history(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    schema: T.StructType,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The spans of every key, as ``scd2`` gives them for all changes at once. A plain scan."""
    state = _table(spark, path, keys, _with_marks(schema, sequence), buckets)
    return spans_of(state.read(), sequence)

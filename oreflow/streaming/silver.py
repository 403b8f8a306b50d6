"""Streaming silver: dedupe with state, enrich with a static dimension, rules with metrics."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from oreflow.operators.quality import Rule, apply_rules, rule_counts

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
METRIC_SCHEMA = "dataset string, rule string, action string, passed bigint, failed bigint"
SEEN = "silver_rules"
POLL_SECONDS, LAST_EVENT_SECONDS = 5, 60
SPLITS = 4  # files of a partition per micro-batch, at most


def dedupe_stream(stream: DataFrame, keys: Sequence[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First arrival of each key. Without a watermark the state keeps every key for ever.

    With ``event_time`` and ``delay`` the state is bounded, and a copy that arrives later than
    the delay may pass again.
    """
    if event_time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


class _Progress(StreamingQueryListener):
    """Collects what one query observes in its micro-batches, in their order.

    Events come on another thread, and after the batch.
    """

    def __init__(self):
        self._lock, self._waiting, self._ended = threading.Condition(), [], set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(SEEN)
        if counts is not None and counts["rows"]:
            with self._lock:
                self._waiting.append((str(event.progress.runId), event.progress.batchId, counts.asDict()))

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait(self, run_id: str) -> None:
        """Until the last event of a run has come."""
        with self._lock:
            self._lock.wait_for(lambda: run_id in self._ended, LAST_EVENT_SECONDS)

    def take(self, run_id: str) -> list[tuple[int, dict]]:
        with self._lock:
            found, self._waiting = self._waiting, []
        return [(batch, counts) for run, batch, counts in found if run == run_id]


def _log(spark: SparkSession, batches: list[tuple[int, dict]], rules: Sequence[Rule], dataset: str, metrics: str) -> None:
    """One folder ``batch=<id>`` per micro-batch, so that a batch is logged once."""
    lines = [
        (batch, dataset, r.name, r.action, counts["rows"] - counts[f"failed_{r.name}"], counts[f"failed_{r.name}"])
        for batch, counts in batches
        for r in rules
    ]
    if lines:
        measured = spark.createDataFrame(lines, f"batch bigint, {METRIC_SCHEMA}").coalesce(1)
        writer = measured.withColumn("logged_at", F.current_timestamp()).write.mode("overwrite").partitionBy("batch")
        writer.option("partitionOverwriteMode", "dynamic").parquet(metrics)


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """RocksDB for a query that is started inside, unless the session has chosen a store."""
    if spark.conf.get(STATE_STORE, None) is not None:
        yield
        return
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE)


def run_silver(
    stream: DataFrame,
    refine: Callable[[DataFrame], DataFrame],
    rules: Sequence[Rule],
    keys: Sequence[str],
    sink: str,
    metrics: str,
    checkpoint: str,
    dataset: str,
    event_time: str | None = None,
    delay: str | None = None,
    partition: tuple[str, Column] | None = None,
) -> None:
    """Drain a bronze stream into silver and write the rule metrics of every micro-batch.

    ``refine`` is the same enrich/type/project function that the batch pipeline uses. The rows go to
    Spark's file sink: its log names the files of whole batches only, so a reader never sees half of
    one, and a replay after a failure adds nothing twice. The rules are counted in the same job, as
    observed metrics; they are logged while the drain runs, a moment after their batch. (A driver
    that is lost in that moment leaves a batch without its metrics, never without its rows.) The
    keys seen so far live in RocksDB, on disk and not in the heap; ``event_time`` and ``delay`` bound
    them. ``partition`` names a column to partition the table by, such as the day.
    """
    spark = stream.sparkSession
    counted = refine(dedupe_stream(stream, keys, event_time, delay)).observe(SEEN, *rule_counts(rules))
    kept, by = apply_rules(counted, rules), []
    if partition is not None:
        name, value = partition
        by = [name]
        # A batch writes a few files per partition, and not one per partition and task.
        kept = kept.withColumn(name, value).repartition(name, F.pmod(F.xxhash64(*keys), F.lit(SPLITS)))
    progress = _Progress()
    spark.streams.addListener(progress)
    try:
        with _state_on_disk(spark):
            writer = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy(*by)
            query = writer.trigger(availableNow=True).start(sink)
        _follow(query, progress, lambda batches: _log(spark, batches, rules, dataset, metrics))
    finally:
        spark.streams.removeListener(progress)


def _follow(query: StreamingQuery, progress: _Progress, log: Callable[[list[tuple[int, dict]]], None]) -> None:
    """Wait for the end of a query and log its batches meanwhile; what was logged stays if it fails."""
    run_id = str(query.runId)
    try:
        while not query.awaitTermination(POLL_SECONDS):
            log(progress.take(run_id))
    finally:
        if query.isActive:
            query.stop()
        progress.wait(run_id)
        log(progress.take(run_id))

"""Change streams: bounded state per key, history spliced from late changes, replays."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.operators.cdc import scd1, scd2
from oreflow.streaming.buckets import BUCKET, BucketedTable
from oreflow.streaming.changes import current_state, history, run_scd1, run_scd2
from tests.conftest import rows

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("gone", T.BooleanType()),
    ]
)
KEYS, SEQUENCE = ["k"], ["at", "n"]
START = datetime(2024, 1, 1)


def change(k, minute, state, gone=False, n=0):
    return (k, START + timedelta(minutes=minute), n, state, gone)


class Feed:
    """A folder that changes land in, and the drain after each landing."""

    def __init__(self, spark, place, run, **options):
        self.spark, self.run, self.options = spark, run, options
        self.source, self.table, self.checkpoint = place("source"), place("table"), place("checkpoint")

    def land(self, *data):
        self.spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(self.source)
        stream = self.spark.readStream.schema(SCHEMA).parquet(self.source)
        if self.run is run_scd1:
            run_scd1(stream, self.table, KEYS, SEQUENCE, self.checkpoint, **self.options)
        else:
            run_scd2(stream, self.table, KEYS, SEQUENCE, ["state"], F.to_date("at"), self.checkpoint, **self.options)

    def state(self, deleted=None):
        return current_state(self.spark, self.table, KEYS, SCHEMA, deleted)

    def spans(self):
        return history(self.spark, self.table, KEYS, SEQUENCE, SCHEMA)


def test_an_older_change_does_not_revive_a_deleted_key(spark, place):
    feed = Feed(spark, place, run_scd1)
    feed.land(change("a", 1, "x"), change("b", 1, "x"))
    feed.land(change("a", 3, "y", True))
    feed.land(change("a", 2, "z"), change("b", 2, "z"))
    assert rows(feed.state(), "k", "state", "gone") == [("a", "y", True), ("b", "z", False)]
    assert rows(feed.state(F.col("gone")), "k") == [("b",)]


def test_the_state_holds_one_row_per_key(spark, place):
    feed, rng, landed = Feed(spark, place, run_scd1), random.Random(1), []
    for _ in range(3):
        batch = [change(f"k{rng.randrange(40)}", rng.randrange(500), rng.choice("xyz"), rng.random() < 0.2, rng.randrange(9**6)) for _ in range(200)]
        landed += batch
        feed.land(*batch)
    want = scd1(spark.createDataFrame(landed, SCHEMA), KEYS, SEQUENCE)
    assert rows(feed.state(), *SCHEMA.names) == rows(want, *SCHEMA.names)
    assert feed.state().count() == len({r[0] for r in landed})


def test_old_tombstones_go(spark, place):
    feed = Feed(spark, place, run_scd1, deleted=F.col("gone"), keep_deleted="1 hour")
    feed.land(change("a", 0, "x", True), change("b", 0, "x"))
    assert rows(feed.state(), "k") == [("a",), ("b",)]
    feed.land(change("a", 30, "y", True))
    assert rows(feed.state(), "k", "state") == [("a", "y"), ("b", "x")]
    # Same bucket, much later: the tombstone has served its time.
    feed.land(change("b", 300, "z"), change("a", 10, "old"))
    assert rows(feed.state(F.col("gone")), "k", "state") == [("b", "z")]


def files_of(spark, table):
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{table}/rows").select("path", "modificationTime")
    return {r["path"] for r in found.collect() if r["path"].endswith(".parquet")}


@pytest.mark.parametrize("run", [run_scd1, run_scd2])
def test_a_batch_replaces_the_buckets_of_its_keys_only(spark, place, run):
    feed = Feed(spark, place, run)
    feed.land(*[change(f"k{i}", 1, "x") for i in range(300)])
    before = files_of(spark, feed.table)
    feed.land(change("k7", 2, "y"))
    after = files_of(spark, feed.table)
    [bucket] = {p.split(f"{BUCKET}=")[1].split("/")[0] for p in before ^ after}
    table = BucketedTable(spark, feed.table, ("k",), SCHEMA)
    assert [int(bucket)] == table.touched(spark.createDataFrame([change("k7", 2, "y")], SCHEMA))
    scan = table.read_buckets([int(bucket)])
    assert len(scan.inputFiles()) >= 1 and f"PartitionFilters: [isnotnull({BUCKET}" in plan(scan)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("hot_rows", [5, 10**9])
def test_late_changes_are_spliced_into_the_history(spark, place, hot_rows):
    rng = random.Random(hot_rows)
    landed = [change(rng.choice("aaaabcde"), rng.randrange(10_000), rng.choice("xy"), n=i) for i in range(400)]
    landed += [change(None, 5, "x", n=1), change(None, 9, None, n=2), change(None, 7, "x", n=3)]
    rng.shuffle(landed)
    feed = Feed(spark, place, run_scd2, hot_rows=hot_rows)
    for part in (landed[:200], landed[200:210], landed[210:] + landed[:50]):
        feed.land(*part)
    want = scd2(spark.createDataFrame(landed, SCHEMA), KEYS, SEQUENCE, ["state"], F.to_date("at"))
    columns = ["k", "state", "n", "valid_from", "valid_to", "is_current"]
    assert rows(feed.spans(), *columns) == rows(want, *columns)


def test_a_late_change_splits_a_span_that_repeats(spark, place):
    feed = Feed(spark, place, run_scd2)
    feed.land(change("a", 1, "x"), change("a", 5, "x"))
    minutes = lambda: [(s, (f - START).seconds // 60, t and (t - START).seconds // 60) for s, f, t in rows(feed.spans(), "state", "valid_from", "valid_to")]
    assert minutes() == [("x", 1, None)]
    feed.land(change("a", 3, "y"))
    assert sorted(minutes(), key=lambda r: r[1]) == [("x", 1, 3), ("y", 3, 5), ("x", 5, None)]
    feed.land(change("a", 3, "y"))
    assert sorted(minutes(), key=lambda r: r[1]) == [("x", 1, 3), ("y", 3, 5), ("x", 5, None)]


@pytest.mark.parametrize("run", [run_scd1, run_scd2])
def test_a_batch_that_is_replayed_after_a_crash_ends_alike(spark, place, run, monkeypatch):
    """The crash comes after the touched buckets are emptied, before their new rows are in place."""
    feed = Feed(spark, place, run)
    feed.land(change("a", 1, "x"), change("b", 1, "x"))
    whole = BucketedTable._read

    def crashing(table, path):
        if path == table.staged_path + "/batch=1":
            table._delete(table.rows_path)
            raise RuntimeError("lost")
        return whole(table, path)

    monkeypatch.setattr(BucketedTable, "_read", crashing)
    with pytest.raises(Exception, match="lost"):
        feed.land(change("a", 2, "y"), change("b", 2, "y"))
    monkeypatch.setattr(BucketedTable, "_read", whole)
    feed.land(change("c", 1, "z"))
    states = rows(feed.state(), "k", "state") if run is run_scd1 else rows(feed.spans().filter("is_current"), "k", "state")
    assert states == [("a", "y"), ("b", "y"), ("c", "z")]
    if run is run_scd2:
        assert feed.spans().count() == 5


def test_an_empty_drain(spark, place):
    feed = Feed(spark, place, run_scd2)
    feed.land()
    assert feed.spans().count() == 0

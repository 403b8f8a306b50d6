"""Silver that appears whole, its metrics, and gold by touched days."""

import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from oreflow.operators.quality import DROP, FAIL, WARN, Rule
from oreflow.streaming import silver
from oreflow.streaming.gold import on_days, refresh_days
from oreflow.streaming.ingest import file_stream
from oreflow.streaming.silver import METRIC_SCHEMA, STATE_STORE, run_silver
from tests.conftest import rows

SCHEMA = "id bigint, day date, amount double"
RULES = [Rule("positive", "amount > 0", DROP), Rule("small", "amount < 100", WARN)]


class Silver:
    def __init__(self, spark, place, rules=RULES, files=1):
        self.spark, self.rules, self.files = spark, rules, files
        self.bronze, self.sink, self.metrics = place("bronze"), place("silver"), place("metrics")
        self.checkpoint, self.gold, self.gold_checkpoint = place("checkpoint"), place("gold"), place("gold-checkpoint")

    def land(self, *data, parts=1):
        frame = self.spark.createDataFrame(list(data), "id bigint, day string, amount double")
        frame.withColumn("day", F.to_date("day")).repartition(parts).write.mode("append").json(self.bronze)

    def run(self):
        stream = file_stream(self.spark, self.bronze, SCHEMA, max_files=self.files)
        by = ("part", F.col("day"))
        run_silver(stream, lambda df: df, self.rules, ["id"], self.sink, self.metrics, self.checkpoint, "t", partition=by)

    def logged(self):
        return rows(self.spark.read.parquet(self.metrics), "batch", "rule", "passed", "failed")

    def refresh(self):
        schema = self.spark.read.parquet(self.sink).schema
        new = file_stream(self.spark, self.sink, schema, "parquet", recursive=False)
        refresh_days(self.spark, new, per_day, self.sink, self.gold, self.gold_checkpoint, "part")


def per_day(silver_rows):
    return silver_rows.groupBy(F.col("day").alias("part")).agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


def test_metrics_of_every_batch_are_logged_once(spark, place):
    t = Silver(spark, place)
    t.land((1, "2024-01-01", 5.0), (1, "2024-01-01", 5.0), (2, "2024-01-02", -1.0))
    t.run()
    t.run()
    t.land((1, "2024-01-01", 5.0), (3, "2024-01-03", 500.0))
    t.run()
    assert t.logged() == [(0, "positive", 1, 1), (0, "small", 2, 0), (1, "positive", 1, 0), (1, "small", 0, 1)]
    assert set(METRIC_SCHEMA.replace(",", "").split()[::2]) < set(spark.read.parquet(t.metrics).columns)
    assert rows(spark.read.parquet(t.sink), "id", "amount") == [(1, 5.0), (3, 500.0)]
    assert spark.conf.get(STATE_STORE, None) is None


def test_a_reader_never_sees_half_a_batch(spark, place):
    """Many small batches of ten rows, each over several files and days, read while they are written."""
    t = Silver(spark, place)
    for b in range(6):
        t.land(*[(b * 10 + i, f"2024-01-{i + 1:02d}", 1.0) for i in range(10)])
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.read.schema("id bigint").parquet(t.sink).count())
            except AnalysisException:
                seen.append(0)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        t.run()
    finally:
        done.set()
        reader.join()
    assert all(n % 10 == 0 for n in seen) and len(set(seen)) >= 3, seen
    assert spark.read.parquet(t.sink).count() == 60


def test_a_failed_batch_leaves_no_rows_and_no_metrics(spark, place):
    t = Silver(spark, place, [Rule("positive", "amount > 0", FAIL)])
    t.land((1, "2024-01-01", 5.0))
    t.run()
    t.land(*[(i, "2024-01-02", 1.0 if i % 5 else -1.0) for i in range(2, 100)], parts=1)
    with pytest.raises(Exception, match="positive"):
        t.run()
    assert rows(spark.read.parquet(t.sink), "id") == [(1,)]
    assert t.logged() == [(0, "positive", 1, 0)]


def test_events_of_other_queries_are_not_logged(spark, place):
    progress = silver._Progress()

    class Event:
        class progress:
            runId, batchId = "other", 3

            class observedMetrics:
                @staticmethod
                def get(name):
                    return None

    progress.onQueryProgress(Event)
    assert progress.take("mine") == []


def test_gold_is_computed_again_for_touched_days_only(spark, place):
    t = Silver(spark, place)
    t.land(*[(i, f"2024-01-{i % 5 + 1:02d}", 1.0) for i in range(20)], (90, None, 7.0))
    t.run()
    t.refresh()
    files = lambda: {r[0] for r in spark.read.parquet(t.gold).select("_metadata.file_path").collect()}
    before = files()
    t.land((100, "2024-01-03", 50.0), (101, "2024-02-01", 1.0), (0, "2024-01-01", 1.0))
    t.run()
    t.refresh()
    after = files()
    changed = {f.split("part=")[1].split("/")[0] for f in before ^ after}
    assert changed == {"2024-01-03", "2024-02-01"}
    want = per_day(spark.read.parquet(t.sink).drop("part"))
    columns = ["part", "n", "amount"]
    assert rows(spark.read.parquet(t.gold), *columns) == rows(want, *columns)
    t.refresh()
    assert files() == after


def test_touched_days_prune_the_scan(spark, place):
    t = Silver(spark, place)
    t.land(*[(i, f"2024-01-{i % 5 + 1:02d}", 1.0) for i in range(20)], (90, None, 7.0))
    t.run()
    whole = spark.read.parquet(t.sink)
    day = next(r[0] for r in whole.select("part").distinct().collect() if r[0] is not None)
    picked = on_days(whole, "part", [day])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan
    assert picked.count() == 4 and on_days(whole, "part", [None, day]).count() == 5
    assert on_days(whole, "part", [None]).count() == 1

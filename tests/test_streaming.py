from pyspark.sql import functions as F

from oreflow.operators.quality import DROP, FAIL, WARN, Rule
from oreflow.plans.jobs import run_fraud_job, run_sales_job
from oreflow.queries.base import Layers
from oreflow.sources import files
from oreflow.sources.files import SOURCE_FILE
from oreflow.streaming.ingest import drain, drain_to_table, file_stream
from oreflow.streaming.silver import dedupe_stream, run_silver
from tests.conftest import rows

SCHEMA = "id bigint, amount double"
RULES = [Rule("id", "id IS NOT NULL", DROP), Rule("positive", "amount > 0", DROP), Rule("small", "amount < 100", WARN)]


def _land(spark, path, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").json(path)


def test_two_drains_and_a_late_file(spark, place):
    source, sink, checkpoint = place("source"), place("sink"), place("checkpoint")
    _land(spark, source, (1, 1.0), (2, 2.0))
    assert drain(spark, source, SCHEMA, sink, checkpoint).count() == 2
    assert drain(spark, source, SCHEMA, sink, checkpoint).count() == 2
    _land(spark, f"{source}/late", (3, 3.0))
    _land(spark, f"{source}/_hidden", (9, 9.0))
    bronze = drain(spark, source, SCHEMA, sink, checkpoint)
    assert rows(bronze, "id", "amount") == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert bronze.select(SOURCE_FILE).distinct().count() == 2
    assert bronze.filter("_ingested_at IS NULL").isEmpty()


def test_ingest_loses_no_field(spark, place):
    source, sink, checkpoint = place("source"), place("sink"), place("checkpoint")
    lines = ['{"id":1,"amount":"n/a"}', '{"id":2,"amount":1.0,"extra":"x"}', '{"id":3,', '{"id":4,"amount":2.0}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(source)
    got = rows(drain(spark, source, SCHEMA, sink, checkpoint), "id", "amount", "_rescued_data")
    assert (1, None, '{"amount":"n/a"}') in got and (2, 1.0, '{"extra":"x"}') in got and (4, 2.0, None) in got
    assert any(r[2] == '{"id":3,' for r in got) and len(got) == 4
    csv, sink, checkpoint = place("csv"), place("sink"), place("checkpoint")
    spark.createDataFrame([("x", "7", "1"), ("y", "n/a", "2")], "extra string, amount string, id string").coalesce(1).write.option(
        "header", True
    ).csv(csv)
    got = rows(drain(spark, csv, SCHEMA, sink, checkpoint, "csv"), "id", "amount", "_rescued_data")
    assert got == [(1, 7.0, '{"extra":"x"}'), (2, None, '{"extra":"y","amount":"n/a"}')]


def test_csv_rows_of_another_length_are_kept_whole(spark, place):
    csv, sink, checkpoint = place("csv"), place("sink"), place("checkpoint")
    lines = ["amount,id", "1.5,1", '2.5,2,"SUR,PLUS",x', "3.5", "n/a,4", "4.5,5,", ","]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(csv)
    got = rows(drain(spark, csv, SCHEMA, sink, checkpoint, "csv"), "id", "amount", "_rescued_data")
    assert got == sorted(
        [
            (1, 1.5, None),
            (2, 2.5, '2.5,2,"SUR,PLUS",x'),
            (None, 3.5, "3.5"),
            (4, None, '{"amount":"n/a"}'),
            (5, 4.5, "4.5,5,"),
            (None, None, None),
        ],
        key=repr,
    )


def test_an_empty_folder_gives_an_empty_table(spark, place):
    source, sink, checkpoint = place("source"), place("sink"), place("checkpoint")
    spark.createDataFrame([], SCHEMA).write.json(f"{source}/_nothing")
    assert drain(spark, source, SCHEMA, sink, checkpoint).count() == 0
    _land(spark, source, (1, 1.0))
    assert drain(spark, source, SCHEMA, sink, checkpoint).count() == 1


def test_drain_into_a_catalog_table(spark, place):
    source = place("source")
    _land(spark, source, (1, 1.0))
    spark.sql("DROP TABLE IF EXISTS oreflow_bronze_test")
    spark.sql(f"CREATE TABLE oreflow_bronze_test ({SCHEMA}) USING parquet LOCATION '{place('table')}'")
    checkpoint = place("checkpoint")
    for _ in range(2):
        drain_to_table(file_stream(spark, source, SCHEMA), "oreflow_bronze_test", checkpoint)
    assert spark.table("oreflow_bronze_test").count() == 1
    spark.sql("DROP TABLE oreflow_bronze_test")


def test_archived_files_leave_the_source(spark, place):
    source, sink, checkpoint, archive = place("source"), place("sink"), place("checkpoint"), place("archive")
    options = {"archive_to": archive, "recursive": False, "max_files": 1}
    for i in range(3):
        _land(spark, source, (i, 1.0))
        drain(spark, source, SCHEMA, sink, checkpoint, **options)
    assert spark.read.parquet(sink).count() == 3
    left = spark.read.format("binaryFile").load(f"{source}/*.json").count()
    assert left < 3


def _silver(spark, place, sink, metrics, checkpoint, bronze, rules=RULES):
    run_silver(
        spark.readStream.schema(SCHEMA).json(bronze),
        lambda df: df.withColumn("double_amount", F.col("amount") * 2),
        rules,
        ["id"],
        sink,
        metrics,
        checkpoint,
        "t",
    )


def test_silver_keeps_one_row_per_id_across_batches_and_logs_metrics(spark, place):
    bronze, sink, metrics, checkpoint = place("bronze"), place("sink"), place("metrics"), place("checkpoint")
    _land(spark, bronze, (1, 5.0), (1, 5.0), (2, -1.0), (3, 500.0))
    _silver(spark, place, sink, metrics, checkpoint, bronze)
    _land(spark, bronze, (1, 5.0), (4, 6.0))
    _silver(spark, place, sink, metrics, checkpoint, bronze)
    assert rows(spark.read.parquet(sink), "id", "double_amount") == [(1, 10.0), (3, 1000.0), (4, 12.0)]
    failed = spark.read.parquet(metrics).groupBy("rule").agg(F.sum("failed")).collect()
    assert {r[0]: r[1] for r in failed} == {"id": 0, "positive": 1, "small": 1}


def test_bad_batch_raises_discards_by_its_size(spark, place):
    bronze, sink, metrics, checkpoint = place("bronze"), place("sink"), place("metrics"), place("checkpoint")
    _land(spark, bronze, (1, 5.0))
    _silver(spark, place, sink, metrics, checkpoint, bronze)
    spark.range(1000, 1500).select("id", F.lit(0.0).alias("amount")).write.json(f"{bronze}/bad")
    run = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).json(bronze)
    run_silver(run, lambda df: df, RULES, ["id"], place("s"), metrics + "2", place("c"), "t")
    total = spark.read.parquet(metrics + "2").filter("rule = 'positive'").agg(F.sum("failed")).first()[0]
    assert total == 500


def test_fail_rule_stops_the_stream(spark, place):
    import pytest
    from pyspark.errors import StreamingQueryException

    bronze = place("bronze")
    _land(spark, bronze, (1, -5.0))
    with pytest.raises(StreamingQueryException):
        _silver(spark, place, place("s"), place("m"), place("c"), bronze, [Rule("positive", "amount > 0", FAIL)])


def test_watermark_dedupe(spark, place):
    source, sink, checkpoint = place("source"), place("sink"), place("checkpoint")
    schema = "id bigint, ts timestamp"
    stamped = spark.range(5).select(F.col("id") % 3, F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"))
    stamped.toDF("id", "ts").write.json(source)
    stream = dedupe_stream(spark.readStream.schema(schema).json(source), ["id"], "ts", "1 hour")
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    query.awaitTermination()
    assert spark.read.parquet(sink).count() == 3


def test_jobs_run_twice_and_match_the_batch_plans(spark, place):
    t = Layers(spark, "/root/testdata/sf0.001")
    raw, out = place("raw"), place("out")
    tx = t.labelled_transactions()
    customers = t.customers()
    tx.filter("tx_id < 'TX5'").write.json(f"{raw}/tx/first")
    customers.coalesce(1).write.option("header", True).csv(f"{raw}/customers")
    schemas = {"transactions": tx.schema, "customers": customers.schema}
    run_fraud_job(spark, f"{raw}/tx", f"{raw}/customers", schemas, out)
    tx.filter("tx_id >= 'TX5'").write.json(f"{raw}/tx/second")
    tx.filter("tx_id < 'TX5'").write.json(f"{raw}/tx/again")
    checks = run_fraud_job(spark, f"{raw}/tx", f"{raw}/customers", schemas, out)
    assert checks.filter("NOT ok").isEmpty()
    gold, want = spark.read.parquet(f"{out}/tables/gold_daily_risk"), t.risk()
    assert rows(gold.select(*want.columns)) == rows(want)


def test_sales_job_matches_the_batch_plan(spark, place):
    t = Layers(spark, "/root/testdata/sf0.001")
    raw, out = place("raw"), place("out")
    sales, products, inventory = t.unique_sales(), t.products(), t.inventory()
    sales.write.json(f"{raw}/sales")
    for name, df in (("products", products), ("inventory", inventory)):
        df.coalesce(1).write.option("header", True).csv(f"{raw}/{name}")
    schemas = {"sales": sales.schema, "products": products.schema, "inventory": inventory.schema}
    for _ in range(2):
        run_sales_job(spark, f"{raw}/sales", f"{raw}/products", f"{raw}/inventory", schemas, out)
    for name, want in (("gold_daily_sales", t.daily()), ("gold_inventory_status", t.status())):
        got = spark.read.parquet(f"{out}/tables/{name}")
        assert rows(got.select(*want.columns)) == rows(want)


def test_only_the_given_days_are_replaced(spark, place):
    path = place("gold")
    files.overwrite_partitions(spark.createDataFrame([(1, "d1"), (2, "d2")], "v int, day string"), path, "day")
    files.overwrite_partitions(spark.createDataFrame([(9, "d2")], "v int, day string"), path, "day")
    assert rows(spark.read.parquet(path), "v", "day") == [(1, "d1"), (9, "d2")]

"""Managed tables, views and SQL with parameters."""

import pytest
from pyspark.sql import functions as F

from oreflow.plans.sales_reports import filtered
from oreflow.queries.sales import DASHBOARD
from oreflow.sources.catalog import append_table, dropped_after, publish_view, quoted, run_sql, save_table
from tests.conftest import rows

DAILY = "day date, country string, category string, units bigint, amount double, profit double, lines bigint"


def daily(spark):
    data = [("2024-01-01", "Côte d'Ivoire", "a"), ("2024-01-02", "x' OR '1' = '1", "b"), ("2024-01-03", None, "b")]
    frame = spark.createDataFrame(data, "day string, country string, category string").withColumn("day", F.to_date("day"))
    return frame.selectExpr("*", "1L AS units", "2D AS amount", "3D AS profit", "4L AS lines")


def test_a_quote_in_a_value_is_a_quote(spark):
    df = daily(spark)
    for country in ("Côte d'Ivoire", "x' OR '1' = '1", "' OR true --", None):
        got = run_sql(spark, DASHBOARD, {"daily": df}, country=country, category=None, first=None, last=None)
        assert rows(got) == rows(filtered(df, country=country).select(got.columns))


def test_markers_and_values_must_agree(spark):
    with pytest.raises(ValueError):
        run_sql(spark, "SELECT :a", b=1)
    with pytest.raises(ValueError):
        run_sql(spark, "SELECT 1", a=1)
    assert run_sql(spark, "SELECT :a::int + 1 AS b, '10:30' AS c", a=1).first() == (2, "10:30")


def test_a_filter_value_reaches_the_scan(spark, place):
    path = place("daily")
    daily(spark).write.parquet(path)
    got = run_sql(spark, "SELECT units FROM {t} WHERE country = :c", {"t": spark.read.parquet(path)}, c="it's")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(country,it's)" in plan and "ReadSchema: struct<country:string,units:bigint>" in plan


def test_a_table_is_replaced_with_its_schema_and_described(spark):
    name = "oreflow_test_gold"
    with dropped_after(spark, name, f"{name}_view"):
        first = spark.createDataFrame([(1, "a")], "id int, name string")
        save_table(first, name, comment="it's gold", comments={"id": "the key"})
        append_table(spark.createDataFrame([("b", 2)], "name string, id int"), name)
        assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
        described = {r[0]: r for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert described["id"][2] == "the key" and described["Comment"][1] == "it's gold"
        with pytest.raises(ValueError):
            append_table(spark.createDataFrame([(1, 2)], "id int, other int"), name)
        publish_view(spark, f"{name}_view", f"SELECT count(*) AS n FROM {name}", "rows; '\\' and quotes")
        assert spark.table(f"{name}_view").first()["n"] == 2
        save_table(spark.createDataFrame([(1.5, "x")], "value double, part string"), name, ["part"])
        assert spark.table(name).columns == ["value", "part"] and spark.table(f"{name}_view").first()["n"] == 1
    assert not spark.catalog.tableExists(name) and not spark.catalog.tableExists(f"{name}_view")


def test_names_are_quoted():
    assert quoted("a.b c`d") == "`a`.`b c``d`"

"""Business semantics on tiny frames, and the shape of the physical plans."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from oreflow.functions.bands import restock_band, risk_band
from oreflow.functions.calendar import calendar_columns, month_distance, parse_timestamp
from oreflow.functions.text import keep_last_four, padded_id
from oreflow.operators.governance import (
    Identity,
    Policy,
    by_attribute,
    by_group,
    comment,
    describe,
    mask_card,
    mask_to_null,
    secure,
    sensitive_scan,
)
from oreflow.operators.models import ModelStore
from oreflow.operators.monitors import completeness, freshness
from oreflow.plans import forecast, fraud_reports, sales, sales_reports
from oreflow.queries import all_queries
from oreflow.queries.base import Layers
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
AS_OF = date(2024, 3, 31)


@pytest.fixture
def status(spark):
    stock = spark.createDataFrame(
        [
            (1, "X", 2, 5, 10),  # under the minimum, nothing sold
            (2, "X", 9, 5, 10),  # nothing sold, stock up: unknown
            (3, "X", 90, 5, 10),  # sells, lasts
            (4, "X", 6, 5, 10),  # sells, runs out before the delivery
        ],
        "product_id bigint, country string, stock_now bigint, stock_min bigint, lead_time_days bigint",
    )
    demand = spark.createDataFrame([(3, "X", 1.0), (4, "X", 1.0)], "product_id bigint, country string, daily_demand double")
    names = spark.createDataFrame([(i, f"p{i}", "c") for i in range(1, 5)], "product_id bigint, product_name string, category string")
    return sales.inventory_status(stock, demand, names)


def test_restock_flag_has_three_values(status):
    assert rows(status, "product_id", "needs_restock") == [(1, True), (2, None), (3, False), (4, True)]
    assert status.filter("needs_restock").count() == 2
    assert status.agg(F.count_if("needs_restock")).first()[0] == 2


def test_unknown_coverage_is_urgent_in_the_list_but_not_in_the_count(status):
    listed = sales_reports.restock_list(status, "X").collect()
    assert [(r["product_id"], r["coverage_days"], r["band"]) for r in listed] == [(1, None, "urgent"), (4, 6.0, "urgent")]
    assert rows(sales_reports.kpi_restock(status, "X")) == [(4, 2, 1)]


def test_demand_divides_by_the_whole_window(spark):
    sold = spark.createDataFrame(
        [(1, "X", 45, "2024-03-01"), (1, "X", 45, "2024-01-01"), (1, "X", 999, "2023-12-31")],
        "product_id bigint, country string, quantity bigint, sold_at string",
    ).withColumn("sold_at", parse_timestamp(F.col("sold_at")))
    assert rows(sales.recent_demand(sold, F.lit(AS_OF))) == [(1, "X", 1.0)]


def test_a_bad_survivor_is_dropped_with_its_good_copy(spark):
    order = {c: 0 for c in sales.SALE_ORDER}
    copies = [
        {"sale_id": "1-1", "l_orderkey": 1, "l_linenumber": 1, **order, "l_partkey": 1, "quantity": 0},
        {"sale_id": "1-1", "l_orderkey": 1, "l_linenumber": 1, **order, "l_partkey": 2, "quantity": 5},
    ]
    raw = spark.createDataFrame(copies).withColumns(
        {
            "product_id": F.col("l_partkey"),
            "sold_at": F.lit("2024-01-01 00:00:00"),
            **{c: F.lit("x") for c in ("country", "channel")},
            **{c: F.lit(1).cast("decimal(18,2)") for c in ("unit_price", "discount_pct", "amount")},
        }
    )
    products = Layers(spark, SF).products()
    assert sales.silver_sales(sales.unique_sales(raw), products).count() == 0


def test_margin_divides_totals_and_survives_zero(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("b", 3.0, 1.0)], "k string, amount double, profit double")
    assert rows(sales_reports.margin_by(df, "k", "amount", "profit"), "k", "margin_pct") == [("a", None), ("b", 0.3333)]


def test_dashboard_parameters_are_literals(spark):
    daily = spark.createDataFrame([("X", "it's", date(2024, 1, 1)), ("Y", "b", date(2024, 2, 1))], "country string, category string, day date")
    assert sales_reports.filtered(daily).count() == 2
    assert sales_reports.filtered(daily, category="it's").count() == 1
    assert sales_reports.filtered(daily, country="X' OR '1'='1").count() == 0
    assert sales_reports.filtered(daily, first=date(2024, 1, 15)).count() == 1


def test_rates_weighted_and_unweighted_differ(spark):
    risk = spark.createDataFrame([(100, 1, 0.01), (1, 1, 1.0)], "transactions bigint, frauds bigint, fraud_rate double")
    assert fraud_reports.overall_rate(risk).first()[0] == pytest.approx(2 / 101, abs=1e-6)
    assert fraud_reports.avg_of_rates(risk).first()[0] == pytest.approx(0.505)


def test_functions(spark):
    one = spark.range(1)
    assert one.select(parse_timestamp(F.lit("abc"))).first()[0] is None
    assert one.select(padded_id("P", F.lit(7), 5), padded_id("P", F.lit(123456), 5), keep_last_four(F.lit("4539-1111-2222-3333"))).first()[:] == (
        "P00007",
        "P123456",
        "****-****-****-3333",
    )
    monday = calendar_columns(F.lit(date(2024, 1, 1)), F.lit(date(2023, 12, 31)))
    assert one.select(monday["weekday"], monday["trend"]).first()[:] == (0, 1)
    assert one.select(month_distance(F.lit(date(2023, 11, 30)), F.lit(date(2024, 1, 1)))).first()[0] == 2
    bands = spark.createDataFrame([(0.1,), (0.2,), (0.5,), (None,)], "p double").select(risk_band(F.col("p")))
    assert [r[0] for r in bands.collect()] == ["low", "medium", "high", None]
    assert one.select(restock_band(F.lit(14.9)), restock_band(F.lit(15.0))).first()[:] == ("soon", "watch")


# -- governance ----------------------------------------------------------------------------------


def test_row_filters_show_nothing_to_strangers(spark):
    df = spark.createDataFrame([("CO", 1), ("US", 2), (None, 3)], "country string, v int")
    by_place = Policy(row_filter=by_attribute("country", "countries"))
    assert secure(df, by_place, Identity("x")).count() == 0
    assert rows(secure(df, by_place, Identity("x", attributes={"countries": ("CO",)}))) == [("CO", 1)]
    grouped = Policy(row_filter=by_group("country", "p_"))
    assert rows(secure(df, grouped, Identity("x", frozenset({"p_US", "other"})))) == [("US", 2)]


def test_masks_keep_types_and_yield_to_groups(spark):
    df = spark.createDataFrame([(1.5, "4539-1111-2222-3333")], "cost double, card string")
    policy = Policy(masks={"cost": mask_to_null, "card": mask_card}, unmasked_groups=frozenset({"audit"}))
    seen = secure(df, policy, Identity("x"))
    assert seen.schema == df.schema and seen.first()[0] is None and seen.first()[1].startswith("****")
    assert rows(secure(df, policy, Identity("y", frozenset({"audit"})))) == rows(df)


def test_gold_is_built_from_unsecured_frames(spark):
    assert Layers(spark, SF).daily().select("country").distinct().count() == 5


def test_sensitive_scan_finds_cards_and_mail(spark):
    df = spark.createDataFrame([("4539-1111-2222-3333", "a@b.co", "x"), ("4539-1111-2222-3334", None, "y")], "c string, m string, o string")
    found = sensitive_scan(df, "t").filter("sensitive")
    assert rows(found, "column_name", "kind") == [("c", "card"), ("m", "email")]


def test_comments_show_in_the_description(spark):
    df = comment(spark.createDataFrame([(1,)], "a int"), a="a number")
    assert rows(describe(df)) == [(0, "a", "int", "a number")]


# -- monitors and forecasts ----------------------------------------------------------------------


def test_completeness_flags_a_short_day(spark):
    counts = [("t", date(2024, 1, d), 100 + d % 3) for d in range(1, 21)] + [("t", date(2024, 1, 21), 10)]
    df = spark.createDataFrame(counts, "series string, day date, rows bigint")
    assert rows(completeness(df, ["series"]).filter("anomaly"), "day") == [(date(2024, 1, 21),)]


def test_freshness_flags_a_late_load(spark):
    times = [i * 60 for i in range(10)] + [9 * 60 + 600]
    df = spark.createDataFrame([("t", x) for x in times], "series string, loaded_at bigint")
    assert rows(freshness(df, ["series"]).filter("late"), "gap") == [(600,)]


def test_forecast_starts_after_the_history(spark):
    history = [(date(2023, 1, 1 + i), c, float(10 + i), i) for i in range(20) for c in ("A", "B")]
    series = spark.createDataFrame(history, "day date, country string, amount double, units bigint")
    ahead = forecast.seasonal_baseline(series, 5)
    assert ahead.count() == 10 and ahead.agg(F.min("day")).first()[0] == date(2023, 1, 21)
    first = ahead.filter("country = 'A'").orderBy("day").first()
    assert first["amount_forecast"] == 30.0


# -- models --------------------------------------------------------------------------------------


class _Model:
    def __init__(self, log):
        self.log = log

    def save(self, path):
        self.log.append(path)


def test_alias_moves_only_to_a_better_model(spark, place):
    store, log = ModelStore(spark, place("models")), []
    with pytest.raises(LookupError):
        store.load("champion")
    assert store.promote("champion", store.save(_Model(log), "v1"), "auc", 0.8)
    assert not store.promote("champion", store.save(_Model(log), "v2"), "auc", 0.7)
    assert store.promote("champion", store.save(_Model(log), "v3"), "auc", 0.9)
    assert store.current("champion")["path"] == log[2]
    assert store.aliases().count() == 2


def test_fraud_model_separates_classes_and_takes_unknown_categories(spark):
    from oreflow.operators.models import with_probability
    from oreflow.queries.models import fraud_store, fraud_table

    t = Layers(spark, SF)
    model = fraud_store(t).load("champion")
    table = fraud_table(t)
    strange = with_probability(model, table.withColumn("channel", F.lit("teleport")))
    p = strange.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0
    quality = all_queries()["score_batch"](spark, SF).first()
    assert quality["auc"] >= 0.80


def test_forest_forecast_is_bounded(spark):
    out = all_queries()["forecast_90d"](spark, SF)
    assert out.count() == 90 * out.select("country").distinct().count()
    assert out.filter("amount_forecast < 0 OR amount_min < 0 OR units_forecast < 0 OR amount_min > amount_max").isEmpty()


# -- physical plans ------------------------------------------------------------------------------


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["gold_daily_sales", "gold_product_sales", "inventory_status", "silver_transactions", "gold_daily_risk", "suspicious_transactions", "scd2"],
)
def test_no_cross_joins_and_no_python_in_the_core_plans(spark, name):
    plan = _plan(all_queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_dedupe_cuts_copies_before_the_joins(spark):
    plan = _plan(all_queries()["gold_daily_sales"](spark, SF))
    assert "WindowGroupLimit" in plan
    assert "o_orderpriority" not in plan and "p_name" not in plan


def test_filters_reach_the_scan(spark):
    seen = secure(Layers(spark, SF).customer, Policy(row_filter=by_attribute("c_mktsegment", "segments")), Identity("x", attributes={"segments": ("BUILDING",)}))
    plan = _plan(seen.select("c_custkey"))
    assert "PushedFilters" in plan and "BUILDING" in plan.split("PushedFilters")[1]
    assert "c_acctbal" not in plan

"""Merged quantiles, seasonal factors and the weekly monitor against plain Python."""

import random
from datetime import date, timedelta
from statistics import median

from pyspark.sql import functions as F

from oreflow.operators import monitors
from oreflow.operators.sketches import merged_sketches, quantile_sketches, rank_error, with_quantiles
from oreflow.plans.season import seasonal_factors
from tests.conftest import rows

START = date(2023, 1, 2)  # a Monday


def test_sketches_merge_over_any_range(spark):
    rng = random.Random(3)
    data = [(rng.choice("aaaab"), i % 40, int(rng.expovariate(0.001))) for i in range(40_000)]
    df = spark.createDataFrame([*data, ("c", 1, None)], "k string, day int, v bigint").repartition(7)
    daily = quantile_sketches(df, "v", ["k", "day"])
    assert daily.filter("k = 'c'").first()["n"] == 0
    for low, high in ((0, 40), (5, 6), (10, 35)):
        found = with_quantiles(merged_sketches(daily.filter(F.col("day").between(low, high - 1)), ["k"]), [0.01, 0.5, 0.99])
        got = found.collect()
        assert {r["k"] for r in got} == {"a", "b"}
        for r in got:
            values = sorted(v for k, d, v in data if k == r["k"] and low <= d < high)
            assert r["n"] == len(values)
            below, upto = sum(v < r["value"] for v in values), sum(v <= r["value"] for v in values)
            error = 2 * rank_error()
            assert below / len(values) - error <= r["p"] <= upto / len(values) + error


def test_a_sketch_reads_the_table_once(spark):
    df = spark.range(1000).select(F.col("id").alias("v"), (F.col("id") % 3).alias("k"))
    plan = quantile_sketches(df, "v", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "ObjectHashAggregate" in plan


def test_seasonal_factors_are_found_again(spark):
    """Days made of known factors; months without their Sundays would mislead plain monthly means."""
    months = [0.5 + 0.1 * i for i in range(12)]
    week = [0.2, 1.0, 1.1, 1.2, 1.3, 1.5, 2.0]
    days = [START + timedelta(i) for i in range(700)]
    days = [d for d in days if not (d.isoweekday() == 7 and d.month in (3, 4))]
    data = [(d, 100.0 * months[d.month - 1] * week[d.isoweekday() % 7]) for d in days]
    got = seasonal_factors(spark.createDataFrame(data, "day date, amount double")).collect()
    level = sum(months[d.month - 1] for d in days) / len(days)
    factor = {(r["kind"], r["part"]): r["factor"] for r in got}
    ratio = {m: factor["month", m] / (months[m - 1] / level) for m in range(1, 13)}
    assert all(abs(r - 1) < 1e-6 for r in ratio.values())
    base = factor["weekday", 1] / week[0]
    assert all(abs(factor["weekday", w] / week[w - 1] / base - 1) < 1e-6 for w in range(1, 8))
    assert sum(r["days"] for r in got if r["kind"] == "month") == len(days)


def test_seasonal_factors_without_all_months(spark):
    data = [(START + timedelta(i), 5.0) for i in range(20)]
    got = seasonal_factors(spark.createDataFrame(data, "day date, amount double")).collect()
    assert {(r["kind"], r["part"]) for r in got} == {("month", 1), *(("weekday", w) for w in range(1, 8))}
    assert all(abs(r["factor"] - 1) < 1e-9 for r in got)
    assert seasonal_factors(spark.createDataFrame([], "day date, amount double")).count() == 0


def brute_weekly(counts, weeks, width, floor):
    out = []
    for series in {s for s, _, _ in counts}:
        of = {d: n for s, d, n in counts if s == series}
        day, filled = min(of), []
        while day <= max(of):
            past = [n for d, n in filled if d.weekday() == day.weekday()][-weeks:]
            n, expected, spread, alarm = of.get(day, 0), None, None, False
            if past:
                expected = float(median(past))
                spread = max(median([abs(x - expected) for x in past]) * 1.4826, expected * floor)
                alarm = len(past) >= monitors.MIN_WEEKS and abs(n - expected) > width * spread
            out.append((series, day, n, alarm))
            filled.append((day, n))
            day += timedelta(1)
    return sorted(out, key=repr)


def weekly(spark, counts, **options):
    df = spark.createDataFrame(counts, "s string, day date, rows bigint")
    return rows(monitors.weekly_completeness(df, ["s"], **options), "s", "day", "rows", "anomaly")


def test_weekly_monitor_matches_brute_force(spark):
    rng = random.Random(5)
    counts = [(s, START + timedelta(i), rng.randrange(0, 60)) for s in ("a", "b") for i in range(90) if rng.random() < 0.9]
    assert weekly(spark, counts, weeks=5, width=1.5) == brute_weekly(counts, 5, 1.5, 0.1)


def test_a_clean_week_is_quiet_and_a_lost_monday_is_not(spark):
    pattern = [100, 110, 120, 130, 300, 20, 10]
    days = [START + timedelta(i) for i in range(70)]
    counts = [("a", d, pattern[d.weekday()]) for d in days]
    assert not any(r[3] for r in weekly(spark, counts))
    lost = days[63]
    assert lost.weekday() == 0
    alarms = [r[1] for r in weekly(spark, [c for c in counts if c[1] != lost]) if r[3]]
    assert alarms == [lost]
    flat = spark.createDataFrame(counts, "s string, day date, rows bigint")
    assert monitors.completeness(flat, ["s"], width=2.0).filter("anomaly").count() > 0

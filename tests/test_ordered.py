import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.operators import metrics, ordered
from oreflow.operators.dedupe import dedupe_by_key, top_per_group
from oreflow.operators.sequences import hot_keys, with_neighbours
from oreflow.operators.splits import recency_split, stratified_split, time_split
from tests.conftest import rows


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v bigint")


@pytest.mark.parametrize("bits", [3, 20])
@pytest.mark.parametrize("top", [1, 50, 2**45, 2**62])
def test_quantiles_match_brute_force_in_any_number_of_layers(spark, monkeypatch, bits, top):
    monkeypatch.setattr(ordered, "LAYER_BITS", bits)
    draw = random.Random(top)
    # A third of all rows share one value.
    values = [draw.randint(0, top) for _ in range(200)] + [top // 2] * 100
    df = _frame(spark, [*values, None])
    for p in (0.0, 0.3, 0.985, 1.0):
        assert ordered.exact_quantile(df, "v", p) == pytest.approx(np.quantile(np.array(values, dtype=float), p))


def test_quantile_of_nothing_and_of_negative_values(spark):
    assert ordered.exact_quantile(_frame(spark, []), "v", 0.5) is None
    with pytest.raises(ValueError):
        ordered.exact_quantile(_frame(spark, [-1, 2]), "v", 0.5)


@pytest.mark.parametrize("largest", [True, False])
def test_extreme_share_keeps_ties(spark, largest):
    values = [5] * 40 + list(range(60))
    got = sorted(r[0] for r in ordered.extreme_share(_frame(spark, values), "v", 0.1, largest).collect())
    ranked = sorted(values, reverse=largest)
    cut = ranked[9]
    assert got == sorted(v for v in values if (v >= cut if largest else v <= cut))


@pytest.mark.parametrize("bits", [2, 21])
def test_auc_matches_brute_force_with_ties(spark, monkeypatch, bits):
    monkeypatch.setattr(metrics, "AUC_LAYER_BITS", bits)
    monkeypatch.setattr(metrics, "AUC_LAYERS", 6 if bits == 2 else 3)
    draw = random.Random(1)
    data = [(draw.randint(-20, 40), draw.random() < 0.3) for _ in range(300)] + [(20, False)] * 150
    pos = [s for s, y in data if y]
    neg = [s for s, y in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = metrics.auc(spark.createDataFrame([*data, (None, True)], "s bigint, y boolean"), "s", F.col("y")).first()
    assert (got["positives"], got["negatives"], got["unscored"]) == (len(pos), len(neg), 1)
    assert got["auc"] == pytest.approx(want, abs=1e-6)


def test_auc_without_positives_is_null(spark):
    df = spark.createDataFrame([(1, False), (2, False)], "s bigint, y boolean")
    assert metrics.auc(df, "s", F.col("y")).first()["auc"] is None


def _neighbours(spark, hot_rows):
    draw = random.Random(3)
    data = [("hot", draw.randint(0, 500), i) for i in range(400)]
    data += [(draw.choice(["a", "b", None]), draw.randint(0, 500), 1000 + i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, t bigint, i bigint")
    hot = hot_keys(df, ["k"], hot_rows)
    return hot, with_neighbours(
        df, ["k"], F.floor(F.col("t") / 50), ["t", "i"], previous=["i"], following=["t", "i"], hot=hot
    )


def test_hot_keys_are_cut_without_changing_the_result(spark):
    none, plain = _neighbours(spark, 10_000)
    some, cut = _neighbours(spark, 90)
    assert none is None and rows(some) == sorted([("hot",), ("a",), ("b",), (None,)], key=repr)
    assert rows(plain, *plain.columns) == rows(cut, *plain.columns)
    assert plain.filter("next_t IS NULL").count() == 4


def test_dedupe_takes_the_first_of_a_total_order_and_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 3, "n"), (None, 1, "m")], "k string, o int, v string")
    once = dedupe_by_key(df, ["k"], ["o", "v"])
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(once) == sorted([("a", 1, "y"), (None, 1, "m")], key=repr)
    top = top_per_group(df, ["k"], [F.desc("o"), F.col("v")], 2)
    assert rows(top.filter("k = 'a'"), "o", "v", "rank") == [(1, "y", 2), (2, "x", 1)]


def test_splits_cover_every_row_once(spark):
    df = spark.range(1000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("day"))
    timed = time_split(df, "day", 10)
    assert timed.filter("part = 'test'").select("day").distinct().count() == 10
    shares = stratified_split(df, F.col("id").cast("string"))
    assert 180 < shares.filter("part = 'test'").count() < 320
    late = recency_split(df, "day", 0.05, df.agg(F.max("day")).scalar())
    assert late.filter("batch = 'late'").select("day").distinct().count() == 5
    whole = late.filter("batch = 'late'").unionAll(late.filter("batch = 'initial'")).drop("batch")
    assert whole.exceptAll(df).isEmpty() and df.exceptAll(whole).isEmpty()

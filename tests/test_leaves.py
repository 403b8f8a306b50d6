"""Several targets from the leaves of one forest."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from oreflow.operators.leaves import LEAVES, leaf_means, predict_by_leaves, with_leaves
from oreflow.operators.models import forest_pipeline


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(8)
    data = []
    for i in range(400):
        kind, x = rng.choice("abc"), rng.random()
        amount = {"a": 10.0, "b": 50.0, "c": 90.0}[kind] + 20 * x
        data.append((i, kind, x, amount, amount / 2 + rng.random()))
    df = spark.createDataFrame(data, "id int, kind string, x double, amount double, units double")
    return forest_pipeline("amount", ["kind"], ["x"], trees=15, depth=5).fit(df), df


def test_means_are_those_of_the_rows_in_a_leaf(fitted):
    model, df = fitted
    leaves = {r["id"]: list(r["l"]) for r in with_leaves(model, df).select("id", vector_to_array(LEAVES).alias("l")).collect()}
    units = {r["id"]: r["units"] for r in df.collect()}
    want = {}
    for i, of in leaves.items():
        for tree, leaf in enumerate(of):
            want.setdefault((tree, leaf), []).append(units[i])
    got = {(r["_tree"], r["_leaf"]): r["units_predicted"] for r in leaf_means(model, df, ["units"]).collect()}
    assert got.keys() == want.keys() and len({t for t, _ in got}) == 15
    assert all(abs(got[k] - sum(v) / len(v)) < 1e-9 for k, v in want.items())


def test_the_second_target_is_predicted_as_well(fitted):
    model, df = fitted
    means = leaf_means(model, df, ["amount", "units"])
    both = predict_by_leaves(model, means, df, ["id"], ["amount", "units"]).join(df, "id")
    error = both.agg(
        F.avg(F.abs(F.col("amount") - F.col("amount_predicted"))).alias("a"),
        F.avg(F.abs(F.col("units") - F.col("units_predicted"))).alias("u"),
        F.count("*").alias("n"),
    ).first()
    assert error["n"] == 400 and error["a"] < 4 and error["u"] < 2.5


def test_unknown_categories_still_reach_a_leaf(spark, fitted):
    model, df = fitted
    strange = spark.createDataFrame([(1, "zzz", 0.5), (2, "a", 0.5)], "id int, kind string, x double")
    got = predict_by_leaves(model, leaf_means(model, df, ["units"]), strange, ["id"], ["units"]).collect()
    assert sorted(r["id"] for r in got) == [1, 2] and all(r["units_predicted"] > 0 for r in got)

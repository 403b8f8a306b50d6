import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from oreflow.operators.joins import grid, join_loss, orphans, require_lossless
from oreflow.operators.quality import (
    DROP,
    FAIL,
    WARN,
    QualityError,
    Rule,
    apply_rules,
    assert_columns,
    check_rows,
    flag_rules,
    gate,
    measure_rules,
    observe_rules,
)
from tests.conftest import rows

RULES = [Rule("id", "id IS NOT NULL", DROP), Rule("positive", "q > 0", DROP), Rule("small", "q < 100", WARN)]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [(1, 5), (2, 0), (3, -4), (4, None), (None, 7), (6, 500)], "id int, q int"
    )


def test_null_predicates_do_not_pass(frame):
    assert rows(apply_rules(frame, RULES)) == [(1, 5), (6, 500)]


def test_warn_keeps_every_row(frame):
    flagged = flag_rules(frame, [RULES[2]])
    assert flagged.count() == 6
    assert flagged.filter("NOT small").count() == 2


def test_metrics_judge_all_rules_on_the_same_rows(frame):
    got = {r["rule"]: (r["action"], r["passed"], r["failed"]) for r in measure_rules(frame, RULES, "t").collect()}
    assert got == {"id": ("drop", 5, 1), "positive": ("drop", 3, 3), "small": ("warn", 4, 2)}


def test_fail_rule_stops_the_job(frame):
    with pytest.raises(PySparkException, match="rule positive failed"):
        apply_rules(frame, [Rule("positive", "q > 0", FAIL)]).collect()


def test_fail_rule_sees_rows_that_a_drop_rule_removes(frame):
    rules = [Rule("positive", "q > 0", DROP), Rule("above", "q > -1", FAIL)]
    with pytest.raises(PySparkException, match="rule above failed"):
        apply_rules(frame.filter("q IS NOT NULL"), rules).collect()


def test_fail_rule_lets_good_rows_through(frame):
    good = frame.filter("q > 0")
    assert apply_rules(good, [Rule("positive", "q > 0", FAIL)]).count() == 3


def test_observation_counts_failures(frame):
    seen = Observation("rules")
    observe_rules(frame, RULES, seen).count()
    assert seen.get == {"rows": 6, "failed_id": 1, "failed_positive": 3, "failed_small": 2}


def test_gate_raises_with_the_names(frame):
    checks = check_rows(frame, {"n": F.count("*")}, [("some", "n", F.col("n") > 0), ("many", "n", F.col("n") > 10)])
    with pytest.raises(QualityError, match="many"):
        gate(checks)


def test_schema_assertion(frame):
    assert_columns(frame, id="int", q="int")
    with pytest.raises(QualityError):
        assert_columns(frame, id="bigint")
    with pytest.raises(QualityError):
        assert_columns(frame, missing="int")


def test_join_loss_counts_hot_and_missing_keys(spark):
    fact = spark.createDataFrame([(1,)] * 1000 + [(2,), (3,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(join_loss(fact, dim, "k")) == [(1003, 1001)]
    assert rows(require_lossless(join_loss(fact, dim, "k"))) == [(1003, 1001)]
    with pytest.raises(PySparkException, match="join lost rows"):
        require_lossless(join_loss(fact, dim.filter("k = 2"), "k")).collect()
    assert orphans(fact, dim, "k").count() == 2


def test_grid_expands_a_list_of_any_length(spark):
    left = spark.createDataFrame([(1,), (2,)], "p int")
    places = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    assert rows(grid(left, places, "c")) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
    many = spark.range(3_000).select(F.col("id").cast("string").alias("c"))
    assert grid(left, many, "c").count() == 6_000

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oreflow.operators.cdc import merge_scd1, scd1, scd2
from oreflow.operators.snapshots import Snapshots, VersionError, update_impact
from tests.conftest import rows

DATA = [(1, 100.0, "CO"), (2, 700.0, "CO"), (3, 520.0, "US"), (4, None, "US")]


@pytest.fixture
def table(spark, place):
    made = Snapshots(spark, place("versioned"), user="tester")
    made.write(spark.createDataFrame(DATA, "id int, amount double, country string"))
    return made


def _all(df):
    return sorted(rows(df), key=lambda r: r[0])


def test_update_counts_matches_and_leaves_null_rows(table):
    assert table.update("amount > 500", amount="amount * 0.8") == 1
    assert _all(table.read()) == [(1, 100.0, "CO"), (2, 560.0, "CO"), (3, 416.0, "US"), (4, None, "US")]
    assert _all(table.read(0)) == DATA
    assert table.history().first()["affected"] == 2


def test_a_second_update_sees_the_rows_of_the_first(table):
    table.update("amount > 500", amount="amount * 0.8")
    table.update("amount > 500", amount="amount * 0.5")
    assert [r[1] for r in _all(table.read())] == [100.0, 280.0, 416.0, None]


def test_delete_restore_and_history(table):
    table.delete("country = 'US'")
    assert [r[0] for r in _all(table.read())] == [1, 2]
    assert table.restore(0) == 2
    assert _all(table.read()) == DATA
    assert [(r["version"], r["operation"], r["user"]) for r in table.history().collect()] == [
        (2, "RESTORE", "tester"),
        (1, "DELETE", "tester"),
        (0, "CREATE OR REPLACE", "tester"),
    ]


def test_append_casts_to_the_table(spark, table):
    table.append(spark.createDataFrame([("CO", 9, 5)], "country string, amount int, id bigint"))
    assert _all(table.read())[-1] == (5, 9.0, "CO") and table.history().first()["affected"] == 1


def test_replace_may_change_the_schema(spark, table):
    table.write(spark.createDataFrame([("x",)], "name string"))
    assert table.read().columns == ["name"] and table.read(0).columns == ["id", "amount", "country"]


def test_time_travel_by_moment(table):
    first = table.history().first()["committed_at"]
    table.delete("id = 1")
    assert table.read_at(first).count() == 4
    assert table.read_at(datetime.now() + timedelta(days=1)).count() == 3
    with pytest.raises(VersionError):
        table.read_at(first - timedelta(seconds=1))
    with pytest.raises(VersionError):
        table.read(7)


def test_no_table_no_version(spark, place):
    with pytest.raises(VersionError):
        Snapshots(spark, place("nothing")).read()


def test_update_impact(spark):
    df = spark.createDataFrame([(5, True), (6, False), (1, False), (None, True)], "a int, f boolean")
    assert rows(update_impact(df, "a > 4", "NOT f")) == [(2, 1, 1)]


CHANGES = [
    ("k1", 1, "a", False),
    ("k1", 2, "a", False),
    ("k1", 3, "b", False),
    ("k1", 4, "a", False),
    ("k2", 1, "x", False),
    ("k2", 5, "x", True),
    ("k3", 2, None, False),
    ("k3", 3, None, False),
]


def test_scd1_takes_the_last_change_and_honours_deletes(spark):
    changes = spark.createDataFrame(CHANGES, "k string, seq int, v string, gone boolean")
    assert rows(scd1(changes, ["k"], ["seq"], F.col("gone")), "k", "seq", "v") == [("k1", 4, "a"), ("k3", 3, None)]


def test_merge_ignores_changes_that_are_older_than_the_state(spark):
    now = spark.createDataFrame([("k", 5, "new")], "k string, seq int, v string")
    late = spark.createDataFrame([("k", 3, "old"), ("j", 1, "j")], "k string, seq int, v string")
    assert rows(merge_scd1(now, late, ["k"], ["seq"])) == [("j", 1, "j"), ("k", 5, "new")]


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_scd2_spans(spark, hot_rows):
    changes = spark.createDataFrame(CHANGES, "k string, seq int, v string, gone boolean")
    spans = scd2(changes, ["k"], ["seq"], ["v"], F.floor(F.col("seq") / 2), hot_rows=hot_rows)
    assert rows(spans, "k", "v", "valid_from", "valid_to", "is_current") == sorted(
        [
            ("k1", "a", 1, 3, False),
            ("k1", "b", 3, 4, False),
            ("k1", "a", 4, None, True),
            ("k2", "x", 1, None, True),
            ("k3", None, 2, None, True),
        ],
        key=repr,
    )

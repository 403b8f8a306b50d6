"""Sensitive columns by several lines of evidence, and policies for all tables."""

import random

import pytest
from pyspark.sql import functions as F

from oreflow.operators.classify import classified, classify_tables, column_profile, kind_tags, luhn, policies_from_tags
from oreflow.operators.governance import Identity, mask_card, mask_to_null, secure
from tests.conftest import rows


def check_digit(payload):
    total = 0
    for i, c in enumerate(reversed(payload), 2):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def card(rng, size=16):
    payload = "4" + "".join(rng.choice("0123456789") for _ in range(size - 2))
    return payload + check_digit(payload)


def test_check_digits(spark):
    rng = random.Random(2)
    good = [card(rng, n) for n in (13, 14, 15, 16, 19) for _ in range(20)]
    bad = [c[:-1] + str((int(c[-1]) + 1) % 10) for c in good]
    got = spark.createDataFrame([(c,) for c in good + bad], "c string").select("c", luhn(F.col("c")).alias("ok")).collect()
    assert {r["c"] for r in got if r["ok"]} == set(good) and all(not r["ok"] for r in got if r["c"] in set(bad))


@pytest.fixture(scope="module")
def verdicts(spark):
    rng = random.Random(4)
    cards = [card(rng) for _ in range(200)]
    grouped = ["-".join(str(rng.randrange(1000, 9999)) for _ in range(4)) for _ in range(200)]
    data = []
    for i in range(200):
        number = str(10**15 + i * 7919)
        data.append(
            (
                cards[i],
                " ".join(cards[i][k : k + 4] for k in range(0, 16, 4)),
                grouped[i],
                number,
                f"u{i}@a-b.example",
                f"10.1.{i % 256}.9",
                f"10.1.{i + 200}.999",
                f"+57 {300 + i} 555 {1000 + i}",
                f"{3000000000 + i}",
                f"{3000000000 + i}",
                cards[i] if i < 100 else "cash",
                None if i else " ",
                f"v{i}",
            )
        )
    names = "pan spaced dashed order_number mail ip not_ip contact mobile_phone account half empty word".split()
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names)).withColumn("amount", F.lit(1.5))
    return {(r["column_name"], r["kind"]): r for r in classify_tables({"t": df}).collect()}


def test_columns_are_told_apart(verdicts):
    sensitive = {k for k, r in verdicts.items() if r["sensitive"]}
    assert sensitive == {
        ("pan", "card"), ("spaced", "card"), ("dashed", "card"), ("mail", "email"), ("ip", "ip_address"),
        ("contact", "phone"), ("mobile_phone", "phone"),
    }
    assert verdicts["pan", "card"]["signs"] == ["checksum", "shape"]
    assert verdicts["order_number", "card"]["signs"] == ["shape"]
    assert verdicts["empty", "card"]["filled"] == 0 and verdicts["half", "card"]["signs"] == []
    assert not any(c == "amount" for c, _ in verdicts)


def test_names_with_dots_and_tables_without_texts(spark):
    df = spark.createDataFrame([("a@b.example", 1)], "`x.y` string, n int")
    assert [r["column_name"] for r in classified(column_profile(df, "t")).filter("sensitive").collect()] == ["x.y"]
    assert classify_tables({"n": df.select("n"), "t": df}).filter("sensitive").count() == 1
    assert classified(column_profile(df.limit(0), "t")).filter("sensitive").count() == 0


def test_every_table_is_masked_by_its_tags(spark):
    rng = random.Random(9)
    one = spark.createDataFrame([(card(rng), f"a{i}@b.example") for i in range(20)], "pan string, mail string")
    two = spark.createDataFrame([(i, card(rng)) for i in range(20)], "id int, paid string")
    three = spark.createDataFrame([("x",)], "word string")
    tags = kind_tags(classify_tables({"one": one, "two": two, "three": three}))
    policies = policies_from_tags(tags, {"card": mask_card, "email": mask_to_null}, frozenset({"desk"}))
    assert set(policies) == {"one", "two"}
    seen = secure(one, policies["one"], Identity("ana"))
    assert seen.filter("pan NOT LIKE '****%' OR mail IS NOT NULL").isEmpty()
    assert secure(two, policies["two"], Identity("ana")).filter("paid LIKE '****%'").count() == 20
    assert rows(secure(two, policies["two"], Identity("bo", frozenset({"desk"})))) == rows(two)


def test_one_pass(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("a"), F.col("id").cast("string").alias("b"))
    plan = column_profile(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Expand" not in plan

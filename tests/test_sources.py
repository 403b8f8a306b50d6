import pytest
from pyspark.sql import types as T

from oreflow.sources import files, schemas
from oreflow.sources.rescue import RESCUED, parse_with_rescue
from tests.conftest import rows

V1 = "id bigint, amount double"


def _json(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_rescue_keeps_unknown_misfit_and_broken_fields(spark):
    lines = spark.createDataFrame(
        [
            ('{"id":1,"amount":2.5}',),
            ('{"id":2,"amount":"n/a"}',),
            ('{"id":3,"amount":1.0,"extra":"x"}',),
            ('{"id":4,"amount":null}',),
            ('{"id":5,',),
            ("",),
        ],
        "value string",
    )
    got = rows(parse_with_rescue(lines, T.StructType.fromDDL(V1)), "id", "amount", RESCUED)
    assert (1, 2.5, None) in got and (4, None, None) in got
    assert (2, None, '{"amount":"n/a"}') in got
    assert (3, 1.0, '{"extra":"x"}') in got
    assert any(r[2] == '{"id":5,' for r in got)
    assert len(got) == 6


def test_csv_columns_are_matched_by_name(spark, place):
    path, mixed = place("csv"), place("mixed")
    spark.createDataFrame([(2, 4, "60")], "product_id int, lead int, stock string").write.option("header", True).csv(path)
    assert rows(files.scan_csv(spark, path, "product_id int, stock int, missing string, lead int")) == [(2, 60, None, 4)]
    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.option("header", True).csv(f"{mixed}/one")
    spark.createDataFrame([(1, 2)], "b int, a int").coalesce(1).write.option("header", True).csv(f"{mixed}/two")
    spark.createDataFrame([("x", 3, 4)], "c string, b int, d int").coalesce(1).write.option("header", True).csv(f"{mixed}/a b")
    got = rows(files.scan_csv(spark, mixed, "a int, b int", recursive=True))
    assert got == sorted([(1, 2), (2, 1), (None, 3)], key=repr)


def test_csv_path_in_sql_reads_the_header_as_data(spark, place):
    path = place("csv")
    files.write_single(spark.createDataFrame([(1, "a")], "id int, name string"), path, "csv")
    trap = spark.sql(f"SELECT * FROM csv.`{path}`")
    assert trap.columns == ["_c0", "_c1"] and trap.count() == 2
    assert rows(files.scan_csv(spark, path, "id int, name string")) == [(1, "a")]
    with pytest.raises(ValueError):
        files.sql_on_files(spark, "csv", path)


def test_schema_is_remembered(spark, place):
    source, saved = place("source"), place("schema")
    _json(spark, source, '{"id":1,"day":"2024-01-01"}')
    first = schemas.remembered_schema(spark, source, "json", saved, {"day": "date"})
    _json(spark, source, '{"id":2,"day":"2024-01-02","new":1}')
    assert schemas.remembered_schema(spark, source, "json", saved) == first
    assert first["day"].dataType == T.DateType()


@pytest.fixture
def changed(spark, place):
    source, saved = place("source"), place("schema")
    _json(spark, source, '{"id":1,"amount":1.0}')
    schemas.evolve(spark, source, "json", saved)
    _json(spark, source, '{"id":2,"amount":1.0,"channel":"web"}')
    return source, saved


def test_new_columns_stop_once_and_are_then_read(spark, changed):
    source, saved = changed
    with pytest.raises(schemas.SchemaChanged, match="channel"):
        schemas.evolve(spark, source, "json", saved)
    schema = schemas.evolve(spark, source, "json", saved)
    assert set(schema.fieldNames()) == {"id", "amount", "channel"}
    assert files.scan_json(spark, source, schema).filter("channel = 'web'").count() == 1


def test_other_policies(spark, changed):
    source, saved = changed
    with pytest.raises(schemas.NewColumnsError):
        schemas.evolve(spark, source, "json", saved, schemas.FAIL_ON_NEW)
    for mode in (schemas.RESCUE, schemas.IGNORE):
        assert set(schemas.evolve(spark, source, "json", saved, mode).fieldNames()) == {"id", "amount"}


def test_widening_lattice():
    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert schemas.wider_type(i, l) == l and schemas.wider_type(l, i) == l and schemas.wider_type(l, d) == d
    assert schemas.wider_type(i, s) is None
    saved, found = T.StructType().add("a", i).add("b", i), T.StructType().add("b", s).add("a", l).add("c", d)
    merged = schemas.merge_schemas(saved, found, widen=True)
    assert [(f.name, f.dataType) for f in merged] == [("a", l), ("b", i), ("c", d)]


def test_widened_frame(spark):
    df = spark.createDataFrame([(1,)], "a int")
    wide = schemas.widen_columns(df, T.StructType().add("a", T.LongType()).add("n", T.StringType()))
    assert rows(wide) == [(1, None)] and dict(wide.dtypes)["a"] == "bigint"


def test_listing_prunes_contents(spark, place):
    path = place("list")
    files.write_fanout(spark.range(10), path, 3)
    listed = files.list_files(spark, path, ".json")
    assert listed.count() == 3
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_random_columns_are_frozen_by_writing(spark):
    from pyspark.sql import functions as F

    from oreflow.session import materialise

    frozen = materialise(spark.range(100).withColumn("r", F.rand()), "random")
    assert rows(frozen) == rows(frozen)


def test_scratch_lives_in_the_clusters_folder(spark, monkeypatch):
    from oreflow import session

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value

    class Fake:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("C", (), {"master": master})()

    assert session.scratch_dir(Fake("s3a://shared/x/", "yarn"), "t").startswith("s3a://shared/x/oreflow/t-")
    with pytest.raises(RuntimeError):
        session.scratch_dir(Fake(None, "yarn"), "t")


def test_scratch_is_empty_afterwards(spark):
    from oreflow.session import materialise, scratch_dir, scratch_scope

    with scratch_scope(spark):
        home = scratch_dir(spark, "probe")
        spark.range(3).write.parquet(home)
        assert materialise(spark.range(5), "probe").count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(home)

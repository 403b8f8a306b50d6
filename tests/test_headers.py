"""CSV files with unlike headers, and schemas inferred from new files only."""

import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.sources import files, headers, schemas
from oreflow.sources.files import SOURCE_FILE
from oreflow.streaming.ingest import drain
from tests.conftest import rows

SCHEMA = "id bigint, amount double"
OUT = ("id", "amount", "_rescued_data")


def put(place, name, *lines):
    """A file with these lines, written as it is."""
    import os

    path = place.removeprefix("file://") + "/" + name
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = "".join(f"{line}\n" for line in lines).encode()
    with open(path, "wb") as out:
        out.write(gzip.compress(data) if name.endswith(".gz") else data)


def test_every_file_goes_by_its_own_header(spark, place):
    source, sink, checkpoint = place("source"), place("sink"), place("checkpoint")
    put(source, "a.csv", "id,amount", "1,1.5", "2,n/a")
    assert rows(drain(spark, source, SCHEMA, sink, checkpoint, "csv"), *OUT) == [(1, 1.5, None), (2, None, '{"amount":"n/a"}')]
    # Later files: another order, a column more, a column less, both, none of ours.
    put(source, "b.csv", "amount,id", "3.5,3")
    put(source, "c.csv", "amount,extra,id", '4.5,"x, y",4')
    put(source, "sub dir/d [1].csv", "id", "5")
    put(source, "e.csv", "other,amount", "z,6.5")
    put(source, "f.csv", "p,q,r,s", "1,2,,4")
    put(source, "g.csv.gz", "amount , id", "7.5,7")
    put(source, "empty.csv")
    put(source, "_hidden.csv", "id,amount", "9,9")
    got = rows(drain(spark, source, SCHEMA, sink, checkpoint, "csv"), *OUT)
    assert got == sorted(
        [
            (1, 1.5, None),
            (2, None, '{"amount":"n/a"}'),
            (3, 3.5, None),
            (4, 4.5, '{"extra":"x, y"}'),
            (5, None, None),
            (None, 6.5, '{"other":"z"}'),
            (None, None, '{"p":"1","q":"2","s":"4"}'),
            (7, 7.5, None),
        ],
        key=repr,
    )


def test_two_unlike_files_in_the_first_drain(spark, place):
    source, sink, checkpoint = place("source"), place("sink"), place("checkpoint")
    put(source, "a.csv", "id,amount", *[f"{i},{i}.0" for i in range(100)])
    put(source, "b.csv", "amount,id", "0.5,1000", "0.5", "0.5,1001,2")
    got = drain(spark, source, SCHEMA, sink, checkpoint, "csv", max_files=1)
    assert got.count() == 103
    assert rows(got.filter("amount = 0.5"), *OUT) == sorted(
        [(1000, 0.5, None), (None, 0.5, "0.5"), (1001, 0.5, "0.5,1001,2")], key=repr
    )


def test_a_large_file_has_one_header(spark, place):
    """The lines after the first split meet the header of the file, too."""
    source = place("source")
    put(source, "a.csv", "amount,id", *[f"{i}.5,{i}" for i in range(20_000)])
    small = {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        got = files.scan_csv(spark, source, SCHEMA)
        assert headers.lines_options(spark.read).load(source).rdd.getNumPartitions() > 3
        assert got.filter("amount = id + 0.5").count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_only_new_headers_are_read(spark, place, monkeypatch):
    source, sink, checkpoint, opened = place("source"), place("sink"), place("checkpoint"), []
    first_line = headers._first_line
    monkeypatch.setattr(headers, "_first_line", lambda s, path: opened.append(path) or first_line(s, path))
    for name in ("a.csv", "b.csv", "c.csv"):
        put(source, name, "id,amount", "1,1.5")
        drain(spark, source, SCHEMA, sink, checkpoint, "csv")
    assert [p.rsplit("/", 1)[1] for p in opened] == ["a.csv", "b.csv", "c.csv"]


def test_a_file_without_a_known_header_stops_the_read(spark, place):
    source = place("source")
    put(source, "a.csv", "id,amount", "1,1.5")
    lines = headers.lines_options(spark.read).load(source)
    lines = lines.select("*", F.col("_metadata.file_path").alias(headers.FILE))
    none = spark.createDataFrame([], headers.HEADER_SCHEMA)
    with pytest.raises(Exception, match="no header is known"):
        headers.split_lines(lines, none).collect()


def test_names_of_a_header():
    assert headers.column_names('a,"b, c",,a,') == ["a", "b, c", "_c2", "a3", "_c4"]
    assert headers.column_names("\ufeffid, x ") == ["id", "x"]
    assert headers.column_names(None) == headers.column_names("") == []


# -- inference -----------------------------------------------------------------------------------


def test_json_schema_from_variants(spark, place):
    source = place("source")
    lines = [
        '{"id":1,"b c":"x","n":null,"o":{"OBJECT<":true,"y":1.5},"list":[1,2],"big":5000000000}',
        '  {"id":2,"b c":3,"late":"2024-01-01","list":[0.5]}',
        '{"broken":',
        "[1,2]",
        "",
    ]
    put(source, "a.json", *lines)
    want = T.StructType.fromDDL(
        "`b c` string, big bigint, id bigint, late string, list array<double>, n string, o struct<`OBJECT<`:boolean,y:double>"
    )
    assert schemas.infer_schema(spark, source, "json") == want
    put(source, "empty/a.json")
    assert schemas.infer_schema(spark, f"{source}/empty", "json") == T.StructType([])


def test_csv_schema_from_all_headers(spark, place):
    source = place("source")
    put(source, "a.csv", "i,l,d,flag,day,at,s,none", "1,5000000000,1.5,true,2024-01-01,2024-01-01 10:00:00,1d,")
    put(source, "b.csv", "extra,i", "7,-2", "8,3,9")
    put(source, "c.csv", "day", "2024-02-30x")
    want = "i int, l bigint, d double, flag boolean, day string, at timestamp, s string, none string, extra int"
    assert schemas.infer_schema(spark, source, "csv") == T.StructType.fromDDL(want)


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_the_second_start_opens_the_new_file_only(spark, place, monkeypatch, fmt):
    source, saved, read = place("source"), place("schema"), []
    infer = schemas.infer_schema

    def watched(spark, path, kind):
        read.append(path)
        return infer(spark, path, kind)

    monkeypatch.setattr(schemas, "infer_schema", watched)
    first, second = ({"json": ('{"id":1}', '{"id":2,"extra":"x"}')}.get(fmt)) or ("1", "2,x")
    heads = {"csv": (["id"], ["id,extra"])}.get(fmt, ([], []))
    put(source, f"a.{fmt}", *heads[0], first)
    schema = schemas.evolve(spark, source, fmt, saved)
    assert schema.fieldNames() == ["id"] == schemas.evolve(spark, source, fmt, saved).fieldNames()
    put(source, f"b c.{fmt}", *heads[1], second)
    with pytest.raises(schemas.SchemaChanged):
        schemas.evolve(spark, source, fmt, saved)
    assert schemas.evolve(spark, source, fmt, saved).fieldNames() == ["id", "extra"]
    assert len(read) == 2 and [p.rsplit("/", 1)[1] for p in read[1]] == [f"b c.{fmt}"]


def test_fail_on_new_columns_fails_until_the_schema_has_them(spark, place):
    source, saved = place("source"), place("schema")
    put(source, "a.csv", "id", "1")
    schema = schemas.evolve(spark, source, "csv", saved, schemas.FAIL_ON_NEW)
    put(source, "b.csv", "id,extra", "1,2")
    for _ in range(2):
        with pytest.raises(schemas.NewColumnsError):
            schemas.evolve(spark, source, "csv", saved, schemas.FAIL_ON_NEW)
    schemas.save_schema(spark, T.StructType([*schema.fields, T.StructField("extra", T.LongType())]), saved)
    assert schemas.evolve(spark, source, "csv", saved, schemas.FAIL_ON_NEW).fieldNames() == ["id", "extra"]


def test_csv_folder_gains_a_column(spark, place):
    source, saved = place("source"), place("schema")
    sink, checkpoint = place("sink"), place("checkpoint")
    put(source, "a.csv", "id,amount", "1,1.5")
    schema = schemas.evolve(spark, source, "csv", saved)
    drain(spark, source, schema, sink, checkpoint, "csv")
    put(source, "b.csv", "extra,id", "x,2")
    with pytest.raises(schemas.SchemaChanged):
        schemas.evolve(spark, source, "csv", saved)
    schema = schemas.evolve(spark, source, "csv", saved)
    got = drain(spark, source, schema, sink, checkpoint, "csv")
    assert rows(got, "id", "amount", "extra") == [(1, 1.5, None), (2, None, "x")]
    assert got.select(SOURCE_FILE).distinct().count() == 2

"""CSV files that each have a header of their own: raw lines, a header per file, and parsing by name."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

FILE, NAMES, LINE, VALUES, BROKEN = "_file", "_names", "_line", "_values", "_broken"
LINE_SCHEMA = "_line string, _torn string"
HEADER_SCHEMA = "_file string, _names array<string>"
# Fixed value: a character that no text file uses, so that a line is one value.
NO_SEPARATOR = "\x01"
READERS = 16
MOST_WIDTHS = 500


def lines_options(reader: DataFrameReader | DataStreamReader) -> DataFrameReader | DataStreamReader:
    """Settings under which the CSV source gives each file's lines after the first, as they are."""
    return (
        reader.format("csv")
        .schema(LINE_SCHEMA)
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", NO_SEPARATOR)
        .option("quote", "")
        .option("columnNameOfCorruptRecord", "_torn")
    )


def listed_files(spark: SparkSession, path: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """The files under a folder, by the names that ``_metadata.file_path`` gives them; nothing is opened."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{FILE} string")
    return files.select(F.col("_metadata.file_path").alias(FILE))


def column_names(header: str | None) -> list[str]:
    """The names in a header line; empty and repeated ones get their place as a suffix."""
    cells = next(csv.reader([(header or "").removeprefix("﻿")]), [])
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = cell.strip() or f"_c{i}"
        names.append(f"{name}{i}" if name in names else name)
    return names


def _first_line(spark: SparkSession, path: str) -> str | None:
    hadoop, io = spark._jvm.org.apache.hadoop, spark._jvm.java.io
    conf = spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(spark._jvm.java.net.URI(path))
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = place.getFileSystem(conf).open(place)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        return io.BufferedReader(io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def read_headers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``_file, _names`` of some files. Only their first lines are read, like the listing by the driver."""
    paths = [r[0] for r in files.collect()]
    with ThreadPoolExecutor(READERS) as pool:
        heads = list(pool.map(lambda path: _first_line(spark, path), paths))
    return spark.createDataFrame([(p, column_names(h)) for p, h in zip(paths, heads, strict=True)], HEADER_SCHEMA)


def known_headers(spark: SparkSession, memory: str) -> DataFrame:
    try:
        return spark.read.schema(HEADER_SCHEMA).parquet(memory)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HEADER_SCHEMA)


def remembered_headers(spark: SparkSession, path: str, memory: str, recursive: bool = True) -> DataFrame:
    """The headers of all files under a folder; those not yet in ``memory`` are read and added to it."""
    fresh = listed_files(spark, path, recursive).join(known_headers(spark, memory), FILE, "left_anti")
    heads = read_headers(spark, fresh)
    if not heads.isEmpty():
        heads.coalesce(1).write.mode("append").parquet(memory)
    return known_headers(spark, memory)


def _split(line: Column, width: int) -> Column:
    """A line's values, and the line itself if it has more or fewer than ``width``."""
    fields = [f"_{i}" for i in range(width)]
    schema = ", ".join(f"{f} string" for f in [*fields, BROKEN])
    parsed = F.from_csv(line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    # A lambda variable is computed once, a repeated expression may be once per use.
    return F.transform(
        F.array(parsed),
        lambda p: F.struct(F.array(*[p[f] for f in fields]).alias(VALUES), p[BROKEN].alias(BROKEN)),
    )[0]


def split_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """``_names, _values, _broken`` for raw lines (``_line, _torn, _file``) of many files, batch or stream.

    Each file's header meets its lines by the file's name, and Spark broadcasts the headers where
    they are small. The number of columns is needed to tell a whole line from a broken one, so there
    is one parser for each width that occurs, and none for each header. A line of a file that
    ``headers`` doesn't know stops the read: it came after the headers were read, and the next run
    has it.
    """
    widths = sorted(r[0] for r in headers.select(F.size(NAMES)).distinct().collect())
    if len(widths) > MOST_WIDTHS:
        raise ValueError(f"{len(widths)} different numbers of columns in one folder")
    own = [c for c in lines.columns if c not in (LINE, "_torn", FILE)]
    met = lines.withColumn(LINE, F.coalesce("_torn", LINE)).join(headers, FILE, "left")
    unknown = F.raise_error(F.concat(F.lit("no header is known yet of "), FILE)).cast(
        f"struct<{VALUES}:array<string>,{BROKEN}:string>"
    )
    parsed = F.when(F.col(NAMES).isNull(), unknown)
    for width in widths:
        parsed = parsed.when(F.size(NAMES) == width, _split(F.col(LINE), width))
    split = met.select(*own, NAMES, parsed.alias("_split"))
    return split.select(*own, NAMES, f"_split.{VALUES}", f"_split.{BROKEN}")


def typed_by_name(rows: DataFrame, schema: T.StructType, rescued: str | None, keep: Sequence[str]) -> DataFrame:
    """The schema's columns by name, and a JSON text ``rescued`` of all that has no place in them.

    Missing columns are NULL. Unknown columns, values that don't fit their type, and whole lines with
    more or fewer values than their header are rescued.
    """
    cells = rows.withColumn("_cells", F.map_from_arrays(NAMES, VALUES))
    typed = {f.name: F.try_element_at("_cells", F.lit(f.name)).try_cast(f.dataType) for f in schema.fields}
    numbered = {f"_typed_{i}": c for i, c in enumerate(typed.values())}
    cells = cells.withColumns(numbered)
    columns = [F.col(c).alias(n) for c, n in zip(numbered, typed, strict=True)]
    if rescued is None:
        return cells.select(*columns, *keep)
    placed = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(n)) for c, n in zip(numbered, typed, strict=True)]))
    lost = F.map_filter("_cells", lambda k, v: v.isNotNull() & ~F.array_contains("_placed", k))
    cells = cells.withColumn("_placed", placed).withColumn("_lost", lost)
    text = F.coalesce(F.col(BROKEN), F.when(F.size("_lost") > 0, F.to_json("_lost")))
    return cells.select(*columns, text.alias(rescued), *keep)

"""Batch file scans, listings, provenance columns and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.text import file_name
from oreflow.sources.headers import FILE, lines_options, listed_files, read_headers, split_lines, typed_by_name

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str, recursive: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", recursive).json(path)


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, recursive: bool = False, provenance: bool = False
) -> DataFrame:
    """CSV with header lines, matched to the schema by name, file by file.

    Files may have their columns in any order, lack some and have others. A value that doesn't fit,
    or a column that a file lacks, is NULL. (A path in SQL, ``csv.`dir```, takes the header for a
    data row.) ``provenance`` adds the columns of ``with_provenance``.
    """
    headers = read_headers(spark, listed_files(spark, path, recursive))
    lines = with_provenance(lines_options(spark.read).option("recursiveFileLookup", recursive).load(path))
    rows = split_lines(lines.withColumn(FILE, F.col(SOURCE_FILE)), headers)
    return typed_by_name(rows, as_struct(schema), None, [INGESTED_AT, SOURCE_FILE] if provenance else [])


def sql_on_files(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """Query a folder by path, without a table; only for self-describing formats."""
    if fmt == "csv":
        raise ValueError("SQL on a csv path reads the header as data; use scan_csv")
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the ingest time and the source file; works on file scans, batch or stream."""
    return df.selectExpr(
        "*", f"current_timestamp() AS {INGESTED_AT}", f"_metadata.file_path AS {SOURCE_FILE}"
    )


def list_files(spark: SparkSession, path: str, suffix: str | None = None, recursive: bool = True) -> DataFrame:
    """File names and sizes; the contents are pruned from the scan."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select(file_name(F.col("path")).alias("file"), F.col("length").alias("bytes"), "path")
    )
    return files.filter(F.col("file").endswith(suffix)) if suffix else files


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows by source file. Names repeat between folders, so the whole path is the key."""
    return (
        df.groupBy(SOURCE_FILE)
        .agg(F.count("*").alias("rows"))
        .withColumn("file", file_name(F.col(SOURCE_FILE)))
        .orderBy(F.desc("rows"), SOURCE_FILE)
    )


def write_fanout(df: DataFrame, path: str, files: int, fmt: str = "json") -> None:
    """A fixed number of files of about equal size."""
    df.repartition(files).write.format(fmt).option("header", True).save(path)


def write_single(df: DataFrame, path: str, fmt: str) -> None:
    """One file; for dimensions and reports, never for facts."""
    df.coalesce(1).write.format(fmt).option("header", True).save(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a dataset and its schema."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace only the partitions that occur in the frame, such as the days just recomputed.

    ``REBALANCE`` gathers each partition into few files and still splits one that is too large.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )

"""Incremental file ingest: every file once, drained and then stopped."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.sources.files import INGESTED_AT, SOURCE_FILE, as_struct, with_provenance
from oreflow.sources.headers import (
    FILE,
    lines_options,
    listed_files,
    read_headers,
    remembered_headers,
    split_lines,
    typed_by_name,
)
from oreflow.sources.rescue import RESCUED, parse_with_rescue

MAX_FILES = 1_000  # per micro-batch, so that a first drain isn't one batch of the whole folder
CSV_LINES = "csv lines"


def file_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    fmt: str = "json",
    recursive: bool = True,
    archive_to: str | None = None,
    max_files: int = MAX_FILES,
) -> DataFrame:
    """A stream over a folder. Hidden names are skipped; sub-folders count when ``recursive``.

    ``archive_to`` moves files away once their batch is committed. CSV headers are compared with
    the schema's names, and a file that differs stops the stream; ``CSV_LINES`` gives the lines
    below each header as they are.
    """
    if fmt == CSV_LINES:
        reader = lines_options(spark.readStream)
    else:
        reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if archive_to is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    return reader.option("recursiveFileLookup", recursive).option("maxFilesPerTrigger", max_files).load(source)


def rescued_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    fmt: str = "json",
    headers: str | None = None,
    **options,
) -> DataFrame:
    """A JSON-lines or CSV stream with provenance that keeps unknown, misfit and broken fields.

    Every CSV file goes by its own header. ``headers`` is a folder beside the checkpoint that
    remembers the headers read so far, so that each run opens new files only.
    """
    wanted = as_struct(schema)
    if fmt == "json":
        lines = file_stream(spark, source, "value string", "text", **options)
        return parse_with_rescue(with_provenance(lines), wanted)
    if fmt != "csv":
        raise ValueError(f"no rescue for {fmt}: its files carry their own types")
    recursive = options.get("recursive", True)
    if headers is None:
        known = read_headers(spark, listed_files(spark, source, recursive))
    else:
        known = remembered_headers(spark, source, headers, recursive)
    lines = with_provenance(file_stream(spark, source, "", CSV_LINES, **options))
    rows = split_lines(lines.withColumn(FILE, F.col(SOURCE_FILE)), known)
    return typed_by_name(rows, wanted, RESCUED, [INGESTED_AT, SOURCE_FILE])


def drain_to(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append what has arrived since the last run to a parquet dataset, then stop.

    The checkpoint remembers the files already read, so a second run adds nothing. It lives
    beside the dataset, never inside it.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(sink)
    )
    query.awaitTermination()


def drain(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    fmt: str = "json",
    rescue: bool = True,
    **options,
) -> DataFrame:
    """Ingest a folder into bronze with provenance columns, and read the result.

    What the schema has no place for is kept in ``_rescued_data``, unless ``rescue`` is off. The
    result is read under the stream's schema, so an empty folder gives an empty frame.
    """
    if rescue and fmt in ("json", "csv"):
        headers = f"{checkpoint}-headers" if fmt == "csv" else None
        stream = rescued_stream(spark, source, schema, fmt, headers=headers, **options)
    else:
        stream = with_provenance(file_stream(spark, source, schema, fmt, **options))
    drain_to(stream, sink, checkpoint)
    try:
        return spark.read.schema(stream.schema).parquet(sink)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stream.schema)


def drain_to_table(stream: DataFrame, table: str, checkpoint: str) -> None:
    """The same into a catalog table."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()

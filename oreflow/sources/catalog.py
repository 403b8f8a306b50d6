"""Tables and views for consumers who know names and SQL, not folders and frames."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

Value = str | int | float | bool | Decimal | date | datetime | None


def quoted(name: str) -> str:
    """``schema.table`` with every part quoted, so that no name can be read as SQL."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def save_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), comment: str | None = None, comments: dict[str, str] | None = None
) -> DataFrame:
    """Replace a managed table and its schema, and describe it; the table as it now reads."""
    for column, text in (comments or {}).items():
        df = df.withMetadata(column, {"comment": text})
    df.write.mode("overwrite").partitionBy(*partition_by).format("parquet").saveAsTable(quoted(name))
    spark = df.sparkSession
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {quoted(name)} IS :text", args={"text": comment})
    return spark.table(quoted(name))


def append_table(df: DataFrame, name: str) -> None:
    """Add rows to a managed table, matched by name; other columns than the table's are an error."""
    columns = df.sparkSession.table(quoted(name)).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {columns}, not {df.columns}")
    df.select(*columns).write.mode("append").format("parquet").saveAsTable(quoted(name))


def publish_view(spark: SparkSession, name: str, query: str, comment: str | None = None) -> DataFrame:
    """A view that the catalog keeps; readers get what the tables hold at that time."""
    about = "" if comment is None else f" COMMENT {_literal(comment)}"
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)}{about} AS {query}")
    return spark.table(quoted(name))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_sql(spark: SparkSession, query: str, frames: dict[str, DataFrame] | None = None, **params: Value) -> DataFrame:
    """A SQL text with markers ``:name`` for values and ``{name}`` for frames.

    Values are bound as typed literals after the text was parsed, so a quote in a value is a quote.
    A marker without a value, or a value without a marker, is an error.
    """
    used = set(re.findall(r"(?<![:\w]):(\w+)", query))
    if used != set(params):
        raise ValueError(f"markers {sorted(used)} and values {sorted(params)} differ")
    return spark.sql(query, args=params or None, **(frames or {}))


@contextmanager
def dropped_after(spark: SparkSession, *names: str) -> Iterator[None]:
    """Tables and views of a block's own are gone after it."""
    try:
        yield
    finally:
        for name in reversed(names):
            kind = "VIEW" if spark.catalog.tableExists(quoted(name)) and spark.catalog.getTable(quoted(name)).tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} IF EXISTS {quoted(name)}")

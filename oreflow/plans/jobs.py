"""The two jobs end to end: files to bronze, silver, gold, and a gate before consumers read.

The order of the calls is the dependency graph; a scheduler of your choice runs the function. Each
layer is a parquet table under ``out``, read back by the next step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.calendar import day_of
from oreflow.operators.quality import gate
from oreflow.plans import fraud, sales, validation
from oreflow.sources.files import overwrite_table
from oreflow.streaming.gold import refresh_days
from oreflow.streaming.ingest import drain, file_stream
from oreflow.streaming.silver import run_silver


@dataclass(frozen=True)
class Places:
    """Where a job keeps its tables and its checkpoints, side by side."""

    out: str

    def table(self, name: str) -> str:
        return f"{self.out}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.out}/checkpoints/{name}"


def _gold(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    overwrite_table(df, path)
    return spark.read.parquet(path)


def _gold_days(
    spark: SparkSession, at: Places, silver: str, name: str, summarise: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """A gold table per day, computed again for the days of the new silver rows only."""
    path = at.table(silver)
    rows = file_stream(spark, path, spark.read.parquet(path).schema, "parquet", recursive=False)
    refresh_days(spark, rows, summarise, path, at.table(name), at.checkpoint(name))
    return spark.read.parquet(at.table(name))


def _dimension(spark: SparkSession, at: Places, name: str, raw: str, schemas: dict[str, T.StructType]) -> DataFrame:
    """New CSV files of a dimension into its bronze table; the job uses the schema's columns."""
    bronze = drain(spark, raw, schemas[name], at.table(f"bronze_{name}"), at.checkpoint(f"bronze_{name}"), "csv")
    return bronze.select(*schemas[name].fieldNames())


def run_sales_job(
    spark: SparkSession,
    raw_sales: str,
    raw_products: str,
    raw_inventory: str,
    schemas: dict[str, T.StructType],
    out: str,
) -> DataFrame:
    """Ingest new sale files, refresh silver and gold, and return the passed checks."""
    at = Places(out)
    products = _dimension(spark, at, "products", raw_products, schemas)
    inventory = _dimension(spark, at, "inventory", raw_inventory, schemas)
    bronze = drain(spark, raw_sales, schemas["sales"], at.table("bronze_sales"), at.checkpoint("bronze_sales"))
    run_silver(
        file_stream(spark, at.table("bronze_sales"), bronze.schema, "parquet", recursive=False),
        lambda lines: sales.refine_sales(lines, products),
        sales.SALES_RULES,
        ["sale_id"],
        at.table("silver_sales"),
        at.table("quality_log"),
        at.checkpoint("silver_sales"),
        "silver_sales",
        partition=("day", day_of(F.col("sold_at"))),
    )
    daily = _gold_days(spark, at, "silver_sales", "gold_daily_sales", sales.gold_daily_sales)
    silver = spark.read.parquet(at.table("silver_sales"))
    _gold(spark, sales.gold_product_sales(silver), at.table("gold_product_sales"))
    as_of = F.lit(silver.agg(F.max(day_of(F.col("sold_at")))).first()[0])
    status = sales.inventory_status(inventory, sales.recent_demand(silver, as_of), products)
    status = _gold(spark, status, at.table("gold_inventory_status"))
    return gate(validation.validate_retail(daily, status))


def run_fraud_job(
    spark: SparkSession, raw_transactions: str, raw_customers: str, schemas: dict[str, T.StructType], out: str
) -> DataFrame:
    """The same for card transactions; also leaves the category means that scoring needs."""
    at = Places(out)
    customers = _dimension(spark, at, "customers", raw_customers, schemas)
    bronze = drain(spark, raw_transactions, schemas["transactions"], at.table("bronze_tx"), at.checkpoint("bronze_tx"))
    run_silver(
        file_stream(spark, at.table("bronze_tx"), bronze.schema, "parquet", recursive=False),
        lambda tx: fraud.refine_transactions(tx, customers),
        fraud.TX_RULES,
        ["tx_id"],
        at.table("silver_tx"),
        at.table("quality_log"),
        at.checkpoint("silver_tx"),
        "silver_transactions",
        partition=("day", day_of(F.col("occurred_at"))),
    )
    risk = _gold_days(spark, at, "silver_tx", "gold_daily_risk", fraud.gold_daily_risk)
    silver = spark.read.parquet(at.table("silver_tx"))
    _gold(spark, fraud.category_means(silver), at.table("category_means"))
    return gate(validation.validate_fraud(risk))

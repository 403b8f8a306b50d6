"""The datasets of one scale folder at each layer, for the named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.fixtures.tables import Tables
from oreflow.functions.money import money_out
from oreflow.plans import fraud, sales
from oreflow.plans.sales_reports import country_daily_series
from oreflow.session import materialise


class Layers(Tables):
    """Raw tables plus silver and gold, all lazy."""

    def silver(self) -> DataFrame:
        return sales.silver_sales(self.unique_sales(), self.products())

    def stored_silver(self) -> DataFrame:
        """Silver as a written table, for reports that read it more than once."""
        return materialise(self.silver(), "silver-sales")

    def daily(self, silver: DataFrame | None = None) -> DataFrame:
        return sales.gold_daily_sales(self.silver() if silver is None else silver)

    def series(self) -> DataFrame:
        """The day series of every country, written once: forecasts read it many times."""
        return materialise(country_daily_series(self.daily()), "country-series")

    def product_sales(self) -> DataFrame:
        return sales.gold_product_sales(self.silver())

    def stored_product_sales(self) -> DataFrame:
        return materialise(self.product_sales(), "product-sales")

    def demand(self, silver: DataFrame | None = None) -> DataFrame:
        return sales.recent_demand(self.silver() if silver is None else silver, self.sales_as_of())

    def status(self, silver: DataFrame | None = None) -> DataFrame:
        return sales.inventory_status(self.inventory(), self.demand(silver), self.products())

    def silver_tx(self) -> DataFrame:
        return fraud.silver_transactions(self.labelled_transactions(), self.customers())

    def unlabelled_tx(self) -> DataFrame:
        """Silver transactions for questions that do not ask for the label."""
        raw = self.transactions().withColumn("is_fraud", F.lit(None).cast("boolean"))
        return fraud.silver_transactions(raw, self.customers()).drop("is_fraud")

    def stored_silver_tx(self) -> DataFrame:
        return materialise(self.silver_tx(), "silver-tx")

    def stored_unlabelled_tx(self) -> DataFrame:
        return materialise(self.unlabelled_tx(), "silver-tx")

    @staticmethod
    def stored_means(silver: DataFrame) -> DataFrame:
        """Category means as a small table, which Spark may broadcast by its file size."""
        return materialise(fraud.category_means(silver), "category-means")

    def risk(self) -> DataFrame:
        return fraud.gold_daily_risk(self.silver_tx())


Query = Callable[[SparkSession, str], DataFrame]


def query(run: Callable[[Layers], DataFrame]) -> Query:
    """A named query: gets the layers, and leaves decimals as doubles at the edge."""

    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return money_out(run(Layers(spark, sf_dir)))

    return call


"""The two business datasets, derived from the given tables (see FIXTURES.md, part 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.buckets import bucket, key_text
from oreflow.functions.money import MONEY, cents_to_money, mean_of
from oreflow.operators.dedupe import dedupe_by_key
from oreflow.operators.joins import grid
from oreflow.operators.layout import spread
from oreflow.operators.ordered import exact_quantile
from oreflow.plans.fraud import HOME_COUNTRY, risk_score
from oreflow.plans.sales import SALE_KEY, SALE_ORDER
from oreflow.session import materialise


# The invalid rows among the sales and transactions (in a thousand), the range of the
# cost rate (in a hundred), and the weights of the card data.
NO_UNITS, RETURNED = 12, 8
NO_AMOUNT, REFUNDED = 13, 7
COST_FROM, COST_RANGE = 45, 28
CHANNELS = (("in_person", 50), ("online", 27), ("mobile", 18), ("atm", 5))
COUNTRIES = (("CO", 960), ("US", 20), ("MX", 12), ("PA", 8))
REGIONS = (("north", 28), ("center", 49), ("south", 23))
DEVICE_SHARE, DEVICE_SHARE_REMOTE = 18, 96
CARD_PREFIX = "4539"
FRAUD_QUANTILE = 0.985


# The schemas of the given tables, so that no job has to read footers first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Tables:
    """The parquet tables of one scale folder, and the datasets made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._threshold: float | None = None
        self._means: DataFrame | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    # -- sales -------------------------------------------------------------------------------

    def lines(self) -> DataFrame:
        return spread(self.lineitem, *SALE_KEY)

    def unique_sales(self) -> DataFrame:
        """``sales`` with one line per sale. The order of copies needs line columns only, so the
        copies go before the joins; the joins neither add nor lose lines."""
        return self.sales(dedupe_by_key(self.lines(), SALE_KEY, SALE_ORDER)).drop(*SALE_KEY, *SALE_ORDER)

    def sales(self, lines: DataFrame | None = None) -> DataFrame:
        """Raw sale lines: text timestamps, repeated ids, zero and negative quantities."""
        # The order side is joined up first: the lines then move once, by order key only.
        places = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "r_name"
        )
        homes = (
            self.customer.select("c_custkey", "c_nationkey")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "r_name")
        )
        headers = (
            self.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
            .join(homes, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "o_orderstatus", "o_orderdate", "r_name")
        )
        placed = (self.lines() if lines is None else lines).join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        b = bucket(
            F.concat(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.lit("q")), 1000
        )
        priced = placed.withColumns(
            {
                "_b": b,
                "_q": F.col("l_quantity").cast("bigint"),
                "_cents": F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            }
        )
        # Half-up division in whole cents: floating division would round ties by engine.
        unit_cents = F.expr("(2 * _cents + _q) div nullif(2 * _q, 0)")
        quantity = by_share(F.col("_b"), [("none", NO_UNITS), ("back", RETURNED), ("sold", 1000 - NO_UNITS - RETURNED)])
        quantity = F.col("_q") * F.element_at(F.create_map(*map(F.lit, ("none", 0, "back", -1, "sold", 1))), quantity)
        priced = priced.withColumns(
            {
                "quantity": quantity.cast("bigint"),
                "unit_price": cents_to_money(unit_cents),
            }
        )
        amount = F.when(F.col("_b") < NO_UNITS + RETURNED, (F.col("quantity") * F.col("unit_price")).cast(MONEY)).otherwise(
            F.col("l_extendedprice").cast(MONEY)
        )
        return priced.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sale_id"),
            timestamp_text("o_orderdate").alias("sold_at"),
            F.col("l_partkey").alias("product_id"),
            F.col("r_name").alias("country"),
            F.when(F.col("o_orderstatus") == "F", "store")
            .when(F.col("o_orderstatus") == "O", "online")
            .otherwise("marketplace")
            .alias("channel"),
            "quantity",
            "unit_price",
            F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
            amount.alias("amount"),
            *SALE_KEY,
            *SALE_ORDER,
        )

    def sales_as_of(self) -> Column:
        """The last order date, as a scalar that the plan computes once."""
        return self.orders.agg(F.max(F.to_date("o_orderdate"))).scalar()

    def products(self) -> DataFrame:
        rate = (F.lit(COST_FROM) + bucket(key_text("c", F.col("p_partkey")), COST_RANGE)).cast("decimal(4,0)")
        cost = F.col("p_retailprice").cast("decimal(9,2)") * rate * F.lit("0.01").cast("decimal(3,2)")
        return self.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").cast(MONEY).alias("list_price"),
            cost.cast(MONEY).alias("unit_cost"),
        )

    def product_countries(self) -> DataFrame:
        """Every product in every country: the short country list expands in place."""
        products = self.part.select(F.col("p_partkey").alias("product_id"))
        countries = self.region.select(F.col("r_name").alias("country"))
        return grid(products, countries, "country")

    def inventory(self) -> DataFrame:
        """Stock of a stable 55% of the product-country pairs."""
        p, c = F.col("product_id"), F.col("country")
        return (
            self.product_countries()
            .filter(bucket(key_text(p, c), 100) < 55)
            .select(
                "product_id",
                "country",
                bucket(key_text("s", p, c), 40).alias("stock_now"),
                (F.lit(5) + bucket(key_text("m", p, c), 15)).alias("stock_min"),
                (F.lit(3) + bucket(key_text("l", p, c), 25)).alias("lead_time_days"),
            )
        )

    # -- transactions ------------------------------------------------------------------------

    def transactions(self) -> DataFrame:
        """Raw card transactions without the fraud label."""
        event, user = F.col("event_id"), F.col("user_id")
        place = bucket(key_text(event, "p"), 1000)
        way = bucket(key_text(event, "h"), 100)
        device = bucket(key_text(event, "d"), 100)
        home = bucket(key_text(user, "r"), 100)
        m = bucket(key_text(event, "m"), 1000)
        value = F.col("value").cast(MONEY)
        card = F.concat_ws(
            "-",
            F.lit(CARD_PREFIX),
            *[F.lpad(bucket(key_text(user, part), 10000).cast("string"), 4, "0") for part in "abc"],
        )
        base = spread(self.events, "event_id").withColumns({"_e": place, "_h": way, "_d": device, "_r": home, "_m": m})
        channel, country = by_share(F.col("_h"), CHANNELS), by_share(F.col("_e"), COUNTRIES)
        remote = F.col("channel").isin("online", "mobile")
        has_device = F.col("_d") < F.when(remote, DEVICE_SHARE_REMOTE).otherwise(DEVICE_SHARE)
        return (
            base.withColumns({"channel": channel, "country": country})
            .select(
                key_text("TX", event).alias("tx_id"),
                user.alias("customer_id"),
                card.alias("card_number"),
                F.col("event_type").alias("merchant_category"),
                "country",
                F.when(F.col("country") == HOME_COUNTRY, "COP").otherwise("USD").alias("currency"),
                "channel",
                by_share(F.col("_r"), REGIONS).alias("region"),
                timestamp_text("ts").alias("occurred_at"),
                F.when(has_device, key_text("D", user)).alias("device_id"),
                F.when(F.col("_m") < NO_AMOUNT, F.lit(0).cast(MONEY))
                .when(F.col("_m") < NO_AMOUNT + REFUNDED, (-value).cast(MONEY))
                .otherwise(value)
                .alias("amount"),
                value.alias("value"),
            )
        )

    def scored_transactions(self) -> DataFrame:
        """Transactions with the rule-based risk, in millionths (a bigint)."""
        tx = self.transactions().join(self.value_means(), "merchant_category")
        return tx.withColumn("risk", risk_score(F.col("value"), F.col("_mean"))).drop("_mean")

    def value_means(self) -> DataFrame:
        """Mean value per category, written once: its file size lets Spark broadcast it, whereas
        an aggregate's size is unknown before it runs and would shuffle the facts by category."""
        if self._means is None:
            means = self.events.groupBy(F.col("event_type").alias("merchant_category")).agg(
                mean_of(F.col("value").cast(MONEY)).alias("_mean")
            )
            self._means = materialise(means, "value-means")
        return self._means

    def labelled_transactions(self) -> DataFrame:
        """Transactions with ``is_fraud``: risk above its exact 0.985 quantile."""
        return self.scored_transactions().withColumn(
            "is_fraud", F.col("risk").cast("double") > F.lit(self.fraud_threshold())
        )

    def fraud_threshold(self) -> float:
        """The exact quantile of the risk, found once per table set by small jobs."""
        if self._threshold is None:
            self._threshold = exact_quantile(self.scored_transactions(), "risk", FRAUD_QUANTILE)
        return self._threshold

    def tx_as_of(self) -> Column:
        return self.events.agg(F.max(F.to_date("ts"))).scalar()

    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        home = bucket(key_text(k, "r"), 100)
        return self.customer.select(
            k.alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
            (F.lit(1) + bucket(key_text("t", k), 178)).alias("tenure_months"),
            by_share(home, REGIONS).alias("region"),
            (F.lit(18) + bucket(key_text("g", k), 71)).alias("age"),
            (F.lit(300) + bucket(key_text("s", k), 551)).alias("credit_score"),
        )


def timestamp_text(column: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a zone-free timestamp."""
    return F.substring(F.col(column).cast("string"), 1, 19)


def by_share(roll: Column, shares: Sequence[tuple[str, int]]) -> Column:
    """A value by weight: ``roll`` is uniform below the sum of the weights."""
    *firsts, (last, _) = shares
    value, edge = F.lit(last), sum(n for _, n in firsts)
    for name, weight in reversed(firsts):
        value = F.when(roll < edge, F.lit(name)).otherwise(value)
        edge -= weight
    return value

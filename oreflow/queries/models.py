"""Training and scoring with distributed learners; checked by rows and by unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.bands import risk_band
from oreflow.operators.leaves import leaf_means, predict_by_leaves
from oreflow.operators.metrics import auc, forecast_errors
from oreflow.operators.models import ModelStore, boosting_pipeline, forest_pipeline, with_probability
from oreflow.operators.splits import stratified_split, time_split
from oreflow.plans import forecast as fc
from oreflow.plans import fraud as fr
from oreflow.queries.base import Layers, query
from oreflow.queries.oracle import sql
from oreflow.session import is_kept, materialise, scratch_dir
from oreflow.streaming.ingest import file_stream
from oreflow.streaming.scoring import score_stream

ALIAS = "champion"
LEAST_AUC = 0.80

_stores: dict[tuple[str, str], tuple[ModelStore, str, str]] = {}
_homes: dict[tuple[str, str], str] = {}


def fraud_table(t: Layers) -> DataFrame:
    """Features with their row key, written once before training reads them many times."""
    return t.spark.read.parquet(_trained(t)[2])


def fraud_store(t: Layers) -> ModelStore:
    return _trained(t)[0]


def stored_means(t: Layers) -> DataFrame:
    """The category means that the champion was trained with; scoring must use the same."""
    return t.spark.read.parquet(_trained(t)[1])


def _split(features: DataFrame) -> DataFrame:
    return stratified_split(features, F.concat(F.col("tx_id"), F.lit("split")))


def _trained(t: Layers) -> tuple[ModelStore, str, str]:
    """A store whose champion is trained on 75% of each class and measured on the rest, and the
    folders of its category means and features."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _stores or not is_kept(_homes[key]):
        home = scratch_dir(t.spark, "models")
        store, means, features = ModelStore(t.spark, f"{home}/store"), f"{home}/means", f"{home}/features"
        silver = t.stored_silver_tx()
        fr.category_means(silver).write.parquet(means)
        table = fr.fraud_features(silver, t.spark.read.parquet(means), keep=["tx_id"])
        table.write.parquet(features)
        split = _split(t.spark.read.parquet(features))
        train, test = split.filter("part = 'train'").drop("part"), split.filter("part = 'test'").drop("part")
        model = boosting_pipeline("is_fraud", fr.CATEGORY_FEATURES, fr.NUMBER_FEATURES).fit(train)
        value = _quality(with_probability(model, test)).first()["auc"]
        store.promote(ALIAS, store.save(model, "v1"), "auc", value if value is not None else 0.0)
        _stores[key], _homes[key] = (store, means, features), home
    return _stores[key]


def _quality(scored: DataFrame) -> DataFrame:
    score = F.round(F.col("fraud_probability") * 1_000_000).cast("bigint")
    return auc(scored.withColumn("_score", score), "_score", F.col("is_fraud") == 1)


def _fraud_scores(t: Layers) -> DataFrame:
    """Every transaction with its probability and band, most suspicious first."""
    scored = with_probability(fraud_store(t).load(ALIAS), fraud_table(t))
    return scored.select(
        "tx_id", "amount", "merchant_category", "channel", "is_fraud", "fraud_probability",
        risk_band(F.col("fraud_probability")).alias("band"),
    ).orderBy(F.desc("fraud_probability"), "tx_id")


def _score_batch(t: Layers) -> DataFrame:
    """The champion's quality on the rows it was not fitted on, and its alias."""
    held_out = _split(fraud_table(t)).filter("part = 'test'").drop("part")
    return _quality(with_probability(fraud_store(t).load(ALIAS), held_out)).withColumn("alias", F.lit(ALIAS))


def _score_checks(t: Layers) -> DataFrame:
    """What must hold of the scores, whatever the model: every row once, in range, and good enough."""
    model = fraud_store(t).load(ALIAS)
    p = F.col("fraud_probability")
    facts = with_probability(model, fraud_table(t)).agg(
        F.count("*").alias("rows"),
        F.count_distinct("tx_id").alias("ids"),
        F.sum(F.col("is_fraud").cast("bigint")).alias("frauds"),
        F.coalesce(F.bool_and(p.between(0.0, 1.0)), F.lit(True)).alias("in_range"),
    )
    held_out = _split(fraud_table(t)).filter("part = 'test'").drop("part")
    quality = _quality(with_probability(model, held_out)).select((F.col("auc") >= LEAST_AUC).alias("good")).scalar()
    return facts.withColumn("good_enough", quality)


def _score_stream(t: Layers) -> DataFrame:
    """Transactions arrive as a stream; each gets its features from the stored means, and a score."""
    silver = t.stored_silver_tx().drop("is_fraud")
    source, sink, checkpoint = (scratch_dir(t.spark, n) for n in ("arrivals", "scored", "checkpoint"))
    silver.write.parquet(source)
    arriving = file_stream(t.spark, source, silver.schema, "parquet", recursive=False)
    features = fr.fraud_features(arriving, stored_means(t), label=False, keep=["tx_id"])
    score_stream(features, fraud_store(t).load(ALIAS), sink, checkpoint)
    return t.spark.read.parquet(sink).select("tx_id", "fraud_probability", "band")


def _stream_checks(t: Layers) -> DataFrame:
    """The stream's scores are those of the batch, once per transaction."""
    batch = with_probability(fraud_store(t).load(ALIAS), fraud_table(t)).select(
        "tx_id", F.col("fraud_probability").alias("_batch")
    )
    both = _score_stream(t).join(batch, "tx_id", "full")
    return both.agg(
        F.count("*").alias("rows"),
        F.count_distinct("tx_id").alias("ids"),
        F.count_if(F.abs(F.col("fraud_probability") - F.col("_batch")) < 1e-9).alias("equal"),
    )


def _forecast(t: Layers) -> DataFrame:
    """Forests for amount and units; the band comes from a back-test on the last 60 days."""
    series, days, origin = _calendar(t)
    future = fc.with_calendar(fc.forecast_grid(series), origin)
    errors = _backtest(days).first()
    return fc.forest_forecast(future, _forest("amount").fit(days), _forest("units").fit(days), errors["residual_sd"])


def _calendar(t: Layers):
    series = t.series()
    origin = F.lit(series.agg(F.min("day")).first()[0])
    numbers = series.withColumns({m: F.col(m).cast("double") for m in ("amount", "units")})
    return series, fc.with_calendar(numbers, origin), origin


def _forest(target: str):
    return forest_pipeline(target, ["country"], fc.CALENDAR_NUMBERS)


def _backtest(days: DataFrame) -> DataFrame:
    """The forest's MAPE and residual deviation on the last 60 days."""
    split = time_split(days, "day", 60)
    tested = _forest("amount").fit(split.filter("part = 'train'")).transform(split.filter("part = 'test'"))
    return forecast_errors(tested, "amount", "amount_predicted")


def _forecast_checks(t: Layers) -> DataFrame:
    """What must hold of a forecast: 90 days per country, an ordered band, nothing below zero."""
    return _sound(materialise(_forecast(t), "forecast"))


def _sound(forecast: DataFrame) -> DataFrame:
    ordered = F.col("amount_min").between(0, F.col("amount_forecast")) & (F.col("amount_forecast") <= F.col("amount_max"))
    return forecast.groupBy("country").agg(
        F.count_distinct("day").alias("days"),
        F.count("*").alias("rows"),
        F.bool_and(ordered & (F.col("units_forecast") >= 0)).alias("sound"),
    )


UNITS_SLACK = 1.25


def _two_targets(t: Layers) -> DataFrame:
    """What must hold of a forecast of both targets from one forest, trained on the amount.

    Its units are back-tested beside a forest of their own, and may be worse by a quarter.
    """
    series, days, origin = _calendar(t)
    days = materialise(days, "days")
    split = time_split(days, "day", 60)
    train, test = split.filter("part = 'train'").drop("part"), split.filter("part = 'test'").drop("part")
    shared = _forest("amount").fit(train)
    means = leaf_means(shared, train, ["amount", "units"])
    predicted = predict_by_leaves(shared, means, test, ["day", "country"], ["amount", "units"])
    tested = materialise(predicted.join(test.select("day", "country", "amount", "units"), ["day", "country"]), "tested")
    own = _forest("units").fit(train).transform(test)
    errors = {name: forecast_errors(*of).first() for name, of in {
        "amount": (tested, "amount", "amount_predicted"),
        "units": (tested, "units", "units_predicted"),
        "own": (own, "units", "units_predicted"),
    }.items()}
    close = errors["units"]["mape"] <= UNITS_SLACK * errors["own"]["mape"]
    future = fc.with_calendar(fc.forecast_grid(series), origin)
    forecast = fc.shared_forest_forecast(future, _forest("amount").fit(days), days, errors["amount"]["residual_sd"])
    return _sound(materialise(forecast, "forecast")).withColumn("units_close", F.lit(close))


def _forest_metrics(t: Layers) -> DataFrame:
    return _backtest(_calendar(t)[1])


def _forest_by_country(t: Layers) -> DataFrame:
    """Totals of the stored forest forecast, as its consumers read them."""
    return fc.forecast_by_country(materialise(_forecast(t), "forecast"))


QUERIES = {
    "forecast_90d": query(_forecast),
    "forecast_checks": query(_forecast_checks),
    "forecast_two_targets": query(_two_targets),
    "forest_metrics": query(_forest_metrics),
    "forest_by_country": query(_forest_by_country),
    "fraud_scores": query(_fraud_scores),
    "score_batch": query(_score_batch),
    "score_checks": query(_score_checks),
    "score_stream": query(_score_stream),
    "score_stream_checks": query(_stream_checks),
}


SQL: dict[str, str] = {
    "forecast_checks": sql(
        "select country, 90 as days, 90 as rows, true as sound from sales group by country", "sales"
    ),
    "forecast_two_targets": sql(
        "select country, 90 as days, 90 as rows, true as sound, true as units_close from sales group by country", "sales"
    ),
    "score_checks": sql(
        """select count(*) as rows, count(*) as ids, count_if(is_fraud)::bigint as frauds, true as in_range,
        true as good_enough from silver_tx where segment is not null""",
        "silver_tx",
    ),
    "score_stream_checks": sql(
        "select count(*) as rows, count(*) as ids, count(*) as equal from silver_tx where segment is not null", "silver_tx"
    ),
}

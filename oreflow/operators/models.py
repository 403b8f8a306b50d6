"""Training, saving by alias, promoting and scoring with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ALIAS_SCHEMA = "alias string, path string, metric string, value double, moved_at timestamp"


def _encoders(categories: Sequence[str], numbers: Sequence[str]) -> list:
    """One-hot categories (unknown ones keep a spare slot) next to the plain numbers."""
    return [
        StringIndexer(
            inputCols=list(categories),
            outputCols=[f"{c}_index" for c in categories],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categories],
            outputCols=[f"{c}_hot" for c in categories],
            handleInvalid="keep",
        ),
        VectorAssembler(inputCols=[*numbers, *[f"{c}_hot" for c in categories]], outputCol="features"),
    ]


def forest_pipeline(
    target: str, categories: Sequence[str], numbers: Sequence[str], trees: int = 200, depth: int = 10, seed: int = 42
) -> Pipeline:
    forest = RandomForestRegressor(
        labelCol=target, predictionCol=f"{target}_predicted", numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[*_encoders(categories, numbers), forest])


def boosting_pipeline(
    label: str, categories: Sequence[str], numbers: Sequence[str], rounds: int = 120, depth: int = 3, seed: int = 42
) -> Pipeline:
    booster = GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed)
    return Pipeline(stages=[*_encoders(categories, numbers), booster])


def with_probability(model: PipelineModel, df: DataFrame, name: str = "fraud_probability") -> DataFrame:
    """Score a batch or a stream; keeps the input columns and adds the probability of class 1."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


class ModelStore:
    """Saved pipelines in folders, and an alias table that says which one is in use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def aliases(self) -> DataFrame:
        """All moves of all aliases."""
        try:
            return self.spark.read.schema(ALIAS_SCHEMA).json(f"{self.path}/aliases")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], ALIAS_SCHEMA)
            raise

    def current(self, alias: str):
        found = self.aliases().filter(F.col("alias") == alias).orderBy(F.desc("moved_at")).limit(1).collect()
        return found[0] if found else None

    def save(self, model: PipelineModel, name: str) -> str:
        path = f"{self.path}/models/{name}"
        model.save(path)
        return path

    def move_alias(self, alias: str, path: str, metric: str, value: float) -> None:
        row = self.spark.range(1).select(
            F.lit(alias).alias("alias"),
            F.lit(path).alias("path"),
            F.lit(metric).alias("metric"),
            F.lit(float(value)).alias("value"),
            F.current_timestamp().alias("moved_at"),
        )
        row.coalesce(1).write.mode("append").json(f"{self.path}/aliases")

    def load(self, alias: str) -> PipelineModel:
        at = self.current(alias)
        if at is None:
            raise LookupError(f"alias {alias} is not set in {self.path}")
        return PipelineModel.load(at["path"])

    def promote(self, alias: str, path: str, metric: str, value: float, larger_is_better: bool = True) -> bool:
        """Move the alias only when the challenger's metric is better than the holder's."""
        holder = self.current(alias)
        if holder is not None:
            better = value > holder["value"] if larger_is_better else value < holder["value"]
            if not better:
                return False
        self.move_alias(alias, path, metric, value)
        return True

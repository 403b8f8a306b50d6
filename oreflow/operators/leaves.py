"""Several targets from one forest: the leaves of its trees as groups, with a mean per target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAVES = "_leaves"


def with_leaves(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The model's output, and the leaf that each row reaches in every tree of its last stage."""
    forest = model.stages[-1].copy()
    forest.set(forest.leafCol, LEAVES)
    return PipelineModel([*model.stages[:-1], forest]).transform(rows)


def _per_tree(scored: DataFrame, *keep: str) -> DataFrame:
    return scored.select(*keep, F.posexplode(vector_to_array(LEAVES)).alias("_tree", "_leaf"))


def leaf_means(model: PipelineModel, train: DataFrame, targets: Sequence[str]) -> DataFrame:
    """``_tree, _leaf`` and the mean of each target among the training rows there.

    At most trees times leaves rows: with 200 trees of depth 10 below 205,000, whatever the
    training rows. Rows meet their leaves by one aggregate with partial sums.
    """
    means = [F.avg(F.col(t).cast("double")).alias(f"{t}_predicted") for t in targets]
    return _per_tree(with_leaves(model, train), *targets).groupBy("_tree", "_leaf").agg(*means)


def predict_by_leaves(model: PipelineModel, means: DataFrame, rows: DataFrame, keys: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """``keys`` and ``<target>_predicted``: the mean over the trees of the leaf a row falls into.

    The trees were grown for one target. Its splits also part the others where they move together,
    which the caller should measure. A leaf that no training row reached (a tree is grown from
    resampled rows) is left out of the mean.
    """
    of_tree = _per_tree(with_leaves(model, rows), *keys).join(means, ["_tree", "_leaf"])
    return of_tree.groupBy(*keys).agg(*[F.avg(f"{t}_predicted").alias(f"{t}_predicted") for t in targets])

"""Model and signal metrics with exact definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AUC_LAYER_BITS, AUC_LAYERS = 21, 3


def auc(df: DataFrame, score: str, label: Column) -> DataFrame:
    """Exact area under the ROC curve of a bigint score of any sign, ties counted half.

    The rows are counted per score, in one pass. The pairs that a positive wins are then added up in layers of
    the score's bits, so every window is bounded and nothing is joined or sorted as a whole. The
    last layer brings the negative scores and the others together. Rows without a score take no
    part and are counted as ``unscored``.
    """
    wide = "decimal(38,0)"
    scored = F.col("k").isNotNull()
    layer = (
        df.groupBy(F.col(score).alias("k"))
        .agg(F.count_if(label).alias("pos"), F.count_if(~label).alias("neg"), F.count("*").alias("unscored"))
        .select(
            "k",
            F.when(scored, F.col("pos")).otherwise(0).cast(wide).alias("pos"),
            F.when(scored, F.col("neg")).otherwise(0).cast(wide).alias("neg"),
            F.when(scored, 0).otherwise(F.col("unscored")).cast(wide).alias("unscored"),
        )
        .withColumn("twice", (F.col("pos") * F.col("neg")).cast(wide))
    )
    for i in range(AUC_LAYERS + 1):
        parent = F.shiftright("k", AUC_LAYER_BITS) if i < AUC_LAYERS else F.lit(0)
        layer = layer.withColumn("parent", parent)
        smaller = Window.partitionBy("parent").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        below = F.coalesce(F.sum("neg").over(smaller), F.lit(0)).cast(wide)
        layer = (
            layer.withColumn("_below", below)
            .withColumn("twice", (F.col("twice") + 2 * F.col("pos") * F.col("_below")).cast(wide))
            .groupBy(F.col("parent").alias("k"))
            .agg(*[F.sum(c).cast(wide).alias(c) for c in ("pos", "neg", "twice", "unscored")])
        )
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return layer.agg(
        F.sum("pos").cast("bigint").alias("positives"),
        F.sum("neg").cast("bigint").alias("negatives"),
        F.sum("twice").alias("_twice"),
        F.coalesce(F.sum("unscored"), F.lit(0)).cast("bigint").alias("unscored"),
    ).select(
        "positives",
        "negatives",
        F.round(F.try_divide(F.col("_twice").cast("double"), pairs), 6).alias("auc"),
        "unscored",
    )


def forecast_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAPE with the divisor floored at 1, and the population deviation of the residuals."""
    residual = F.col(actual) - F.col(predicted)
    return df.agg(
        F.count("*").alias("rows"),
        F.avg(F.abs(residual) / F.greatest(F.abs(F.col(actual)), F.lit(1.0))).alias("mape"),
        F.stddev_pop(residual).alias("residual_sd"),
    )


def lift(df: DataFrame, label: Column, signals: dict[str, Column]) -> DataFrame:
    """Rows (signal, rows, frauds, rate, lift) from one pass over the table."""
    everything = {"base": F.lit(True), **signals}
    summed = df.agg(
        *[F.count_if(on).alias(f"r_{name}") for name, on in everything.items()],
        *[F.count_if(on & label).alias(f"f_{name}") for name, on in everything.items()],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("signal"),
                F.col(f"r_{name}").alias("rows"),
                F.col(f"f_{name}").alias("frauds"),
                F.col("r_base").alias("_rows"),
                F.col("f_base").alias("_frauds"),
            )
            for name in everything
        ]
    )
    rate = F.try_divide(F.col("frauds").cast("double"), F.col("rows").cast("double"))
    base = F.try_divide(F.col("_frauds").cast("double"), F.col("_rows").cast("double"))
    return summed.select(F.inline(lines)).select(
        "signal", "rows", "frauds", F.round(rate, 6).alias("rate"), F.round(F.try_divide(rate, base), 4).alias("lift")
    )

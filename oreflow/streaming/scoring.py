"""Score a stream of transactions with a saved model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.bands import risk_band
from oreflow.operators.models import with_probability
from oreflow.streaming.ingest import drain_to


def score_stream(stream: DataFrame, model: PipelineModel, sink: str, checkpoint: str) -> None:
    scored = with_probability(model, stream)
    drain_to(scored.withColumn("band", risk_band(F.col("fraud_probability"))), sink, checkpoint)

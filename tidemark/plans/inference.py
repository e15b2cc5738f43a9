"""Batch scoring of a gold table."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas as S
from tidemark.operators import features, scoring
from tidemark.sinks.files import write_layer
from tidemark.sources.files import load_model, read_layer


def batch_predictions(
    gold_df: DataFrame, model: PipelineModel, threshold: float = S.SERVING_THRESHOLD
) -> DataFrame:
    """Scan, project, drop incomplete rows, score, decide: one narrow stage."""
    return scoring.predict(features.scoring_set(gold_df), model, threshold)


def respond(
    requests: DataFrame,
    model: PipelineModel,
    threshold: float = S.SERVING_THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """Requests, batch or stream, to responses; ``keep`` passes request columns through."""
    return scoring.responses(scoring.apply_model(requests, model), threshold, keep)


def run_batch_inference(
    spark: SparkSession,
    gold_path: str,
    model_path: str,
    out: str,
    threshold: float = S.SERVING_THRESHOLD,
) -> DataFrame:
    """Score the gold layer and write the predictions; returns them as written."""
    model = load_model(model_path)
    write_layer(batch_predictions(read_layer(spark, gold_path), model, threshold), out)
    return read_layer(spark, out)

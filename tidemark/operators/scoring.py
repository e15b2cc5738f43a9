"""From a probability to decisions, labels and responses, row by row."""

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C


def apply_model(rows: DataFrame, model: Transformer) -> DataFrame:
    """Add ``no_show_probability``; works alike on batch and streaming rows."""
    return model.transform(rows).select(
        *rows.columns, C.positive_probability().alias("no_show_probability")
    )


def decide(scored: DataFrame, threshold: float = S.SERVING_THRESHOLD) -> DataFrame:
    """Add ``predicted_no_show`` at the serving threshold."""
    return scored.withColumn(
        "predicted_no_show", C.serving_decision("no_show_probability", threshold)
    )


def predict(rows: DataFrame, model: Transformer, threshold: float = S.SERVING_THRESHOLD):
    """Scoring rows to prediction rows; ids and features stay on their own row."""
    return decide(apply_model(rows, model), threshold).select(*S.PREDICTIONS)


def consolidated(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("prediction_label", C.decision_label()).select(*S.CONSOLIDATED)


def responses(
    scored: DataFrame, threshold: float = S.SERVING_THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """What a caller gets per request row: rounded score, decision, label, threshold.

    The decision is taken on the unrounded score.
    """
    return decide(scored, threshold).select(
        *(keep or []),
        F.round("no_show_probability", 4).alias("no_show_probability"),
        "predicted_no_show",
        C.decision_label().alias("prediction_label"),
        F.lit(threshold).alias("threshold"),
    )

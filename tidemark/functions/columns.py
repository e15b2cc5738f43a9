"""Column expressions. Each returns a ``Column`` that stays inside whole-stage codegen."""

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schemas as S


def label_flag(column: str = S.LABEL) -> Column:
    """1 for ``Yes``; anything else, NULL included, is 0."""
    return F.col(column).eqNullSafe("Yes").cast("int")


def gender_name(column: str = "Gender") -> Column:
    """``F`` is Female; anything else, NULL included, is Male."""
    return F.when(F.col(column).eqNullSafe("F"), "Female").otherwise("Male")


def event_time(column: str, strict: bool = True) -> Column:
    """Text or timestamp to timestamp. Unreadable text raises, or is NULL if not strict."""
    return F.to_timestamp(column) if strict else F.try_to_timestamp(F.col(column))


def days_between(start: str, end: str) -> Column:
    """Signed calendar days in the session zone."""
    return F.date_diff(F.to_date(end), F.to_date(start))


def age_band(column: str = "Age") -> Column:
    """Half-open age bands; a NULL age falls through to the oldest band."""
    (limit, name), *rest = S.AGE_BANDS
    start = F.when(F.col(column) < limit, name)
    bands = reduce(lambda chain, band: chain.when(F.col(column) < band[0], band[1]), rest, start)
    return bands.otherwise(S.OLDEST_BAND)


def chronic_count() -> Column:
    """Hipertension plus Diabetes; NULL if either is."""
    return F.col("Hipertension") + F.col("Diabetes")


def positive_probability(column: str = "probability") -> Column:
    """Class-1 entry of a Spark ML probability vector."""
    return vector_to_array(F.col(column))[1]


def score_or_class(score: str, predicted: str) -> Column:
    """The score, or the predicted class where a model gives no score."""
    return F.coalesce(F.col(score), F.col(predicted).cast("double"))


def serving_decision(score: str, threshold: float = S.SERVING_THRESHOLD) -> Column:
    """Inclusive threshold, unlike Spark ML's own."""
    return (F.col(score) >= F.lit(threshold)).cast("int")


def evaluation_class(score: str) -> Column:
    """Most likely class; an exact tie is class 0."""
    return (F.col(score) > F.lit(S.EVALUATION_THRESHOLD)).cast("int")


def decision_label(column: str = "predicted_no_show") -> Column:
    return F.when(F.col(column) == 1, S.POSITIVE_LABEL).otherwise(S.NEGATIVE_LABEL)

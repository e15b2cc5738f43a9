"""The feature recipe, defined once for batch and stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C


def drop_copies(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication, NULLs equal.

    Partial aggregation folds copies inside each task, so a row repeated across the
    whole table reaches its reducer once per task and not once per copy.
    """
    return df.dropDuplicates()


def valid_age(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Age") >= 0)


def not_past(df: DataFrame) -> DataFrame:
    return df.filter(F.col("days_until_appointment") >= 0)


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without NULL or NaN in any column."""
    return df.dropna()


def silver(
    raw: DataFrame, dedupe: bool = True, validate_age: bool = True, strict: bool = True
) -> DataFrame:
    """Raw rows, cleaned: distinct, recoded, with real timestamps.

    Copies are judged on the raw values, before any recode can make rows look alike.
    Catalyst moves the age filter below the de-duplication.
    """
    df = drop_copies(raw) if dedupe else raw
    df = valid_age(df) if validate_age else df
    df = df.withColumnRenamed("No-show", S.LABEL)
    recoded = {
        "Gender": C.gender_name(),
        "ScheduledDay": C.event_time("ScheduledDay", strict),
        "AppointmentDay": C.event_time("AppointmentDay", strict),
    }
    if S.LABEL in df.columns:
        recoded[S.LABEL] = C.label_flag()
    return df.withColumns(recoded)


def derive(silver_df: DataFrame) -> DataFrame:
    """Add the derived features to silver rows."""
    return silver_df.withColumns(
        {
            "age_group": C.age_band(),
            "sms_received_flag": F.col("SMS_received").cast("int"),
            "days_until_appointment": C.days_between("ScheduledDay", "AppointmentDay"),
            "chronic_disease_count": C.chronic_count(),
        }
    )


def gold(silver_df: DataFrame) -> DataFrame:
    """Narrow: no shuffle between silver and gold."""
    return not_past(derive(silver_df).select(*S.GOLD))


def training_set(gold_df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Complete feature and label rows; ``keep`` passes further columns through.

    Only the features and the label decide whether a row is complete.
    """
    return gold_df.select(*(keep or []), *S.TRAINING).dropna(subset=S.TRAINING)


def scoring_set(gold_df: DataFrame) -> DataFrame:
    return complete_rows(gold_df.select(*S.SCORING))


def featurize(
    raw: DataFrame, dedupe: bool = False, validate_age: bool = False, strict: bool = False
) -> DataFrame:
    """Raw events to scoring rows in one narrow step.

    The defaults are the stream's: no de-duplication, no age check and unreadable dates
    dropped. With all three on, the rows are those the batch layers give.
    """
    rows = derive(silver(raw, dedupe, validate_age, strict))
    return complete_rows(not_past(rows.select(*S.SCORING)))

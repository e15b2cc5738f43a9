"""Schemas, column lists and constants shared by batch and stream."""

from pyspark.sql import types as T

# --- Fixed values: names, types and numbers that are part of the data contract ---

RAW_FIELDS = [
    ("PatientId", "double"),
    ("AppointmentID", "int"),
    ("Gender", "string"),
    ("ScheduledDay", "timestamp"),
    ("AppointmentDay", "timestamp"),
    ("Age", "int"),
    ("Neighbourhood", "string"),
    ("Scholarship", "int"),
    ("Hipertension", "int"),
    ("Diabetes", "int"),
    ("Alcoholism", "int"),
    ("Handcap", "int"),
    ("SMS_received", "int"),
    ("No-show", "string"),
]

IDS = ["PatientId", "AppointmentID"]
CATEGORICAL = ["Gender", "age_group"]
NUMERIC = [
    "Age",
    "Scholarship",
    "Hipertension",
    "Diabetes",
    "Alcoholism",
    "Handcap",
    "sms_received_flag",
    "days_until_appointment",
    "chronic_disease_count",
]
FEATURES = ["Gender", "Age", "age_group"] + NUMERIC[1:]
LABEL = "no_show"

GOLD = IDS + ["Gender", "Age", "age_group", "Neighbourhood"] + NUMERIC[1:] + [LABEL]
SCORING = IDS + FEATURES
TRAINING = FEATURES + [LABEL]
PREDICTIONS = SCORING + ["no_show_probability", "predicted_no_show"]
CONSOLIDATED = PREDICTIONS + ["prediction_label"]

AGE_BANDS = [(18, "child"), (40, "young_adult"), (65, "adult")]
OLDEST_BAND = "senior"
POSITIVE_LABEL, NEGATIVE_LABEL = "Likely No-show", "Likely Show"
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

SERVING_THRESHOLD = 0.30
EVALUATION_THRESHOLD = 0.5
TEST_FRACTION = 0.2
SEED = 42
EXPERIMENT = "no_show_prediction"
MODEL_NAME = "NoShowPredictionModel"
SELECTION_METRIC = "roc_auc"
METRICS = ["accuracy", "roc_auc", "precision", "recall", "f1_score"]

# --- End of fixed values ---

CORRUPT = "_corrupt_record"


TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "map": T.MapType(T.StringType(), T.StringType()),
}


def _struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


def raw_schema(appointment_id: str = "int") -> T.StructType:
    """Batch schema: both days are timestamps.

    ``appointment_id="bigint"`` widens the id for sources that outgrow 32 bits.
    """
    kinds = {**dict(RAW_FIELDS), "AppointmentID": appointment_id}
    return _struct(list(kinds.items()))


def event_schema(appointment_id: str = "int", corrupt: bool = False) -> T.StructType:
    """Stream schema: both days arrive as text; ``corrupt`` keeps unreadable lines."""
    kinds = {**dict(RAW_FIELDS), "AppointmentID": appointment_id}
    fields = [(n, "string" if kind == "timestamp" else kind) for n, kind in kinds.items()]
    return _struct(fields + ([(CORRUPT, "string")] if corrupt else []))


def request_schema() -> T.StructType:
    """One scoring request: the features alone, typed."""
    return _struct([(c, "string" if c in CATEGORICAL else "int") for c in FEATURES])


RUNS_SCHEMA = _struct(
    [
        ("experiment", "string"),
        ("seq", "int"),
        ("run_id", "string"),
        ("run_name", "string"),
        ("model_type", "string"),
        *[(metric, "double") for metric in METRICS],
        ("params", "map"),
        ("uri", "string"),
    ]
)

REGISTRY_SCHEMA = _struct(
    [("name", "string"), ("version", "int"), ("run_id", "string"), ("uri", "string")]
)

PINNED_SCHEMA = _struct([("batch_id", "bigint"), ("uri", "string")])

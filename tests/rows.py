"""Small literal frames in the raw event shape."""

from tidemark import schemas as S

EVENT = {
    "PatientId": 1.0,
    "AppointmentID": 1,
    "Gender": "F",
    "ScheduledDay": "2024-03-01T08:00:00Z",
    "AppointmentDay": "2024-03-05T00:00:00Z",
    "Age": 30,
    "Neighbourhood": "CENTRO",
    "Scholarship": 0,
    "Hipertension": 0,
    "Diabetes": 1,
    "Alcoholism": 0,
    "Handcap": 0,
    "SMS_received": 1,
    "No-show": "No",
}


def event(**changes) -> dict:
    return {**EVENT, **changes}


def raw(spark, *events):
    """Rows with both days as text."""
    names = list(EVENT)
    return spark.createDataFrame([tuple(e[n] for n in names) for e in events], S.event_schema())


def edits(spark, *changes):
    """One event per set of changes, with ids 1, 2, ..."""
    return raw(spark, *[event(**{"AppointmentID": i + 1, **c}) for i, c in enumerate(changes)])

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import DateTimeException
from pyspark.sql import functions as F
from rows import edits, event, raw

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators import features

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def by_id(df, column):
    return {r["AppointmentID"]: r[column] for r in df.collect()}


def test_recodes_send_null_and_unknown_to_the_default(spark):
    df = features.silver(
        edits(
            spark,
            {"Gender": "F", "No-show": "Yes"},
            {"Gender": "M", "No-show": "No"},
            {"Gender": None, "No-show": None},
            {"Gender": "X", "No-show": "yes"},
        )
    )
    assert by_id(df, "Gender") == {1: "Female", 2: "Male", 3: "Male", 4: "Male"}
    assert by_id(df, "no_show") == {1: 1, 2: 0, 3: 0, 4: 0}


AGES = [-1, 0, 17, 18, 39, 40, 64, 65, None]
BANDS = [
    "child",
    "child",
    "child",
    "young_adult",
    "young_adult",
    "adult",
    "adult",
    "senior",
    "senior",
]


def test_age_bands(spark):
    df = edits(spark, *[{"Age": a} for a in AGES]).withColumn("band", C.age_band())
    assert list(by_id(df, "band").values()) == BANDS


def test_age_filter_drops_negative_and_null(spark):
    df = edits(spark, *[{"Age": a} for a in AGES])
    assert sorted(by_id(features.silver(df), "Age").values()) == [0, 17, 18, 39, 40, 64, 65]
    assert features.silver(df, validate_age=False).count() == len(AGES)
    # A stream keeps negative ages as children and loses only the unknown one.
    scored = features.featurize(df)
    assert sorted(by_id(scored, "Age").values()) == [-1, 0, 17, 18, 39, 40, 64, 65]
    assert by_id(scored, "age_group")[1] == "child"


def test_same_day_counts_as_zero_days_and_the_past_is_dropped(spark):
    df = edits(
        spark,
        {"ScheduledDay": "2024-03-01T18:38:08Z", "AppointmentDay": "2024-03-01T00:00:00Z"},
        {"ScheduledDay": "2024-03-02T00:00:00Z", "AppointmentDay": "2024-03-01T23:59:59Z"},
        {"AppointmentDay": None},
    )
    assert by_id(features.gold(features.silver(df)), "days_until_appointment") == {1: 0}


def test_the_pinned_zone_is_what_keeps_same_day_rows(spark):
    df = edits(
        spark, {"ScheduledDay": "2024-03-01T18:38:08Z", "AppointmentDay": "2024-03-01T00:00:00Z"}
    )
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert features.gold(features.silver(df)).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert features.gold(features.silver(df)).count() == 1


def test_malformed_days_fail_a_batch_but_not_a_stream(spark):
    df = edits(spark, {"ScheduledDay": "soon"}, {})
    with pytest.raises(DateTimeException):
        features.silver(df).collect()
    assert by_id(features.featurize(df), "Age") == {2: 30}


def test_timestamps_pass_through_both_parsers(spark):
    df = edits(spark, {}).withColumn("ScheduledDay", F.to_timestamp("ScheduledDay"))
    for strict in (True, False):
        row = features.silver(df, strict=strict).select(F.date_format("ScheduledDay", "HH")).first()
        assert row[0] == "08"


def test_copies_are_whole_rows_with_null_equal_to_null(spark):
    df = raw(
        spark,
        event(),
        event(),
        event(Age=31),
        event(Gender=None, Neighbourhood=None),
        event(Gender=None, Neighbourhood=None),
    )
    assert features.drop_copies(df).count() == 3


def test_copies_fold_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, *[event()] * 500, event(Age=31)).repartition(4).write.parquet(path)
    rows = features.drop_copies(spark.read.parquet(path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert plan.count("Exchange") == 1 and "HashAggregate" in below
    assert rows.count() == 2


def test_rows_that_recode_alike_are_not_copies(spark):
    df = raw(spark, event(Gender="M"), event(Gender="X"))
    assert features.silver(df).count() == 2


def test_chronic_count_uses_two_conditions_and_keeps_null(spark):
    df = edits(
        spark,
        {"Hipertension": 1, "Diabetes": 1, "Alcoholism": 1, "Handcap": 4},
        {"Hipertension": 1, "Diabetes": None},
    )
    gold = features.gold(features.silver(df))
    assert by_id(gold, "chronic_disease_count") == {1: 2, 2: None}
    assert features.scoring_set(gold).count() == 1
    assert features.training_set(gold).count() == 1


def test_incomplete_rows_include_nan_ids(spark):
    df = edits(spark, {"PatientId": float("nan")}, {"PatientId": None}, {})
    gold = features.gold(features.silver(df))
    assert by_id(features.scoring_set(gold), "Age") == {3: 30}
    # Neither the ids nor the neighbourhood decide on a training row.
    assert features.training_set(gold, keep=S.IDS).count() == 3


def test_column_orders(spark):
    gold = features.gold(features.silver(edits(spark, {})))
    assert gold.columns == S.GOLD
    assert features.scoring_set(gold).columns == S.SCORING
    assert features.training_set(gold).columns == S.TRAINING
    assert features.featurize(edits(spark, {})).columns == S.SCORING


def test_a_stream_without_labels_is_accepted(spark):
    assert features.featurize(edits(spark, {}).drop("No-show")).count() == 1


def test_gold_adds_no_shuffle_and_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    features.silver(edits(spark, {}, {"Age": 50})).write.parquet(path)
    rows = features.training_set(features.gold(spark.read.parquet(path)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PatientId" not in plan and "Neighbourhood" not in plan
    bronze = str(tmp_path / "bronze")
    edits(spark, {}).write.parquet(bronze)
    plan = features.silver(spark.read.parquet(bronze))._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(Age,0)" in plan.toString()


row_strategy = st.fixed_dictionaries(
    {
        "AppointmentID": st.integers(1, 3),
        "Age": st.one_of(st.none(), st.integers(-3, 99)),
        "Gender": st.sampled_from(["F", "M", None]),
        "Diabetes": st.sampled_from([0, 1, None]),
    }
)


@FEW
@given(st.lists(row_strategy, min_size=1, max_size=12))
def test_silver_against_plain_python(spark, changes):
    events = [event(**c) for c in changes]
    distinct = {tuple(e.values()) for e in events}
    kept = [e for e in distinct if e[5] is not None and e[5] >= 0]
    got = features.silver(raw(spark, *events))
    assert sorted(r["Age"] for r in got.collect()) == sorted(e[5] for e in kept)


@FEW
@given(st.lists(st.integers(0, 110), min_size=1, max_size=20))
def test_bands_partition_the_ages(spark, ages):
    rows = edits(spark, *[{"Age": a} for a in ages]).withColumn("band", C.age_band()).collect()
    edges = {"child": (0, 18), "young_adult": (18, 40), "adult": (40, 65), "senior": (65, 999)}
    assert all(edges[r["band"]][0] <= r["Age"] < edges[r["band"]][1] for r in rows)

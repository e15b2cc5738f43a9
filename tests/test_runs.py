import csv
import glob

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import models, ranking
from tidemark.plans import registry, training
from test_models import planted


def runs(spark, *rows):
    """(seq, run_name, roc_auc, experiment) rows as run records."""
    data = [
        (exp, i, f"id{i}", name, "m", 0.5, auc, None, None, None, {"C": "1"}, f"uri/{name}")
        for i, name, auc, exp in rows
    ]
    return spark.createDataFrame(data, S.RUNS_SCHEMA)


def test_leaderboard_orders_ties_by_name_and_nulls_last(spark):
    board = ranking.leaderboard(
        runs(spark, (0, "c", 0.7, "e"), (1, "b", None, "e"), (2, "a", 0.7, "e"), (3, "d", 0.9, "e"))
    )
    assert [(r["rank"], r["run_name"]) for r in board.collect()] == [
        (1, "d"),
        (2, "a"),
        (3, "c"),
        (4, "b"),
    ]


def test_top_runs_come_worst_first(spark):
    many = runs(spark, *[(i, f"r{i:02}", i / 100, "e") for i in range(20)])
    top = ranking.top_runs(many).collect()
    assert [r["rank"] for r in top] == list(range(15, 0, -1))
    assert top[-1]["run_name"] == "r19"


def test_best_run_is_the_first_of_equals(spark):
    table = runs(spark, (0, "z", 0.6, "e"), (1, "y", 0.8, "e"), (2, "a", 0.8, "e"))
    assert ranking.best_run(table).first()["run_name"] == "y"


def test_best_run_needs_a_metric(spark):
    assert ranking.best_run(runs(spark, (0, "z", None, "e"))).first() is None


def test_best_in_experiment_ignores_the_others(spark):
    table = runs(spark, (0, "a", 0.9, "other"), (1, "b", None, "e"), (2, "c", 0.1, "e"))
    assert ranking.best_run_in_experiment(table, "e").first()["run_name"] == "c"


def test_versions_count_up_per_name(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.register(spark, path, "r1", "u1", "one") == 1
    assert registry.register(spark, path, "r2", "u2", "one") == 2
    assert registry.register(spark, path, "r3", "u3", "two") == 1
    assert registry.latest_uri(spark, path, "one") == "u2"
    assert registry.latest_uri(spark, path, "two") == "u3"
    with pytest.raises(ValueError, match="No registered model"):
        registry.latest_uri(spark, path, "three")


def test_best_past_run_is_registered(spark, tmp_path):
    path, versions = str(tmp_path / "runs"), str(tmp_path / "registry")
    with pytest.raises(ValueError, match="No runs found"):
        registry.register_best_past_run(spark, path, versions)
    registry.append_runs(runs(spark, (0, "a", 0.4, S.EXPERIMENT)), path)
    registry.append_runs(runs(spark, (1, "b", 0.6, S.EXPERIMENT)), path)
    assert registry.read_runs(spark, path).count() == 2
    assert registry.register_best_past_run(spark, path, versions) == 1
    assert registry.latest_uri(spark, versions) == "uri/b"


SMALL = [
    models.Candidate("lr", "logistic_regression", {"C": 1}),
    models.Candidate("rf", "random_forest", {"n_estimators": 3, "max_depth": None}),
    models.Candidate(
        "gb", "gradient_boosting", {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 2}
    ),
]


def test_grid_end_to_end(spark, tmp_path):
    out = str(tmp_path / "experiment")
    gold_path = str(tmp_path / "gold")
    planted(spark, 1500).write.parquet(gold_path)
    gold = spark.read.parquet(gold_path)
    board = training.train_grid(gold, out, SMALL).collect()
    assert [r["rank"] for r in board] == [1, 2, 3]
    assert all(0 <= r[m] <= 1 for r in board for m in S.METRICS)
    (best,) = [r for r in board if r["rank"] == 1]
    assert registry.latest_uri(spark, f"{out}/registry") == best["uri"]
    assert {r["run_name"]: r["params"] for r in board}["rf"] == {
        "n_estimators": "3",
        "max_depth": "30",
    }
    (file,) = glob.glob(f"{out}/leaderboard/*.csv")
    with open(file) as f:
        lines = list(csv.DictReader(f))
    assert [line["run_name"] for line in lines] == [r["run_name"] for r in board]
    assert list(lines[0]) == [
        "run_id",
        "run_name",
        "model_type",
        *S.METRICS,
        "C",
        "n_estimators",
        "max_depth",
        "learning_rate",
    ]
    # A second experiment adds to the same tables; comparing alone registers nothing.
    training.train_grid(gold, out, SMALL[:1], select=False)
    assert registry.read_runs(spark, f"{out}/runs").count() == 4
    assert registry.read_registry(spark, f"{out}/registry").count() == 1


def test_a_grid_without_the_metric_says_so(spark, tmp_path):
    """One positive row: the test part has one class, so no run has an AUC."""
    gold_path = str(tmp_path / "gold")
    rows = planted(spark, 100).withColumn("no_show", (F.col("AppointmentID") == 1).cast("int"))
    rows.write.parquet(gold_path)
    with pytest.raises(ValueError, match="roc_auc"):
        training.train_grid(spark.read.parquet(gold_path), str(tmp_path / "out"), SMALL[:1])


def test_a_hot_profile_is_in_both_parts(spark):
    """Half of a class has the same features: a fifth of its rows are test rows."""
    gold = planted(spark, 4000)
    hot = F.col("AppointmentID") % 2 == 0
    same = {c: F.when(hot, F.lit(1)).otherwise(F.col(c)) for c in S.NUMERIC}
    same |= {"Gender": F.when(hot, "Male").otherwise(F.col("Gender"))}
    same |= {"age_group": F.when(hot, "child").otherwise(F.col("age_group"))}
    same |= {"no_show": F.when(hot, 1).otherwise(F.col("no_show"))}
    prepared = training.prepare(gold.withColumns(same), keep=S.IDS)
    parts = [prepared.rows(part).filter(hot).count() for part in ("train", "test")]
    assert 0.16 < parts[1] / sum(parts) < 0.24


def test_fitting_may_be_bounded(spark):
    prepared = training.prepare(planted(spark, 4000), fit_rows=500)
    assert 400 < prepared.train.count() < 600
    assert training.prepare(planted(spark, 400)).train.count() == 320

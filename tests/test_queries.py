"""Every registered query against its SQL counterpart, on whole tables."""

import os

import pytest
from compare import assert_same

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert assert_same(QUERIES[name](spark, FOLDER), ORACLES[name], FOLDER) > 0


# FIXTURES.md §3, at the smallest scale and the next
@pytest.mark.parametrize(
    "folder, rows, by_age, after_dropna",
    [
        ("sf0.001", 2963, {"child": 546, "young_adult": 688, "adult": 780, "senior": 949}, 2795),
        ("sf0.01", 29071, {"child": 5747, "young_adult": 6770, "adult": 7396, "senior": 9158}, 27238),
    ],
)
def test_recorded_counts(spark, folder, rows, by_age, after_dropna):
    path = f"/root/testdata/{folder}"
    gold = QUERIES["gold"](spark, path).cache()
    assert gold.count() == rows
    assert {r[0]: r[1] for r in gold.groupBy("age_group").count().collect()} == by_age
    assert QUERIES["training_set"](spark, path).count() == after_dropna
    gold.unpersist()


def test_flagship_has_the_gold_columns(spark):
    from tidemark import schemas as S

    assert contract.entry(spark).columns == S.GOLD


@pytest.mark.parametrize("name, expected", [("lr_scores", 1), ("rf_scores", 1), ("gbt_scores", 1)])
def test_scores_cover_the_test_part(spark, name, expected):
    scores = QUERIES[name](spark, FOLDER)
    assert scores.filter("p < 0 OR p > 1 OR p IS NULL").count() == 0
    assert scores.count() == 559  # ceil(0.2 * 2795)
    assert scores.select("run_name").distinct().count() == expected


def test_grid_leaderboard_ranks_every_candidate(spark):
    board = QUERIES["grid_leaderboard"](spark, FOLDER).collect()
    assert [r["rank"] for r in board] == [1, 2, 3]
    assert sorted(r["seq"] for r in board) == [0, 1, 2]
    assert [r["roc_auc"] for r in board] == sorted((r["roc_auc"] for r in board), reverse=True)


def test_train_report_supports_add_up(spark):
    rows = {r["row"]: r for r in QUERIES["train_report"](spark, FOLDER).collect()}
    assert rows["0"]["support"] + rows["1"]["support"] == rows["accuracy"]["support"] == 559

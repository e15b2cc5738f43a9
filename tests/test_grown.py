"""Forests and boosting whose trees tasks grow, and that grids fit on all rows."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from test_models import planted
from tidemark import schemas as S
from tidemark.operators import boosting, forest, models, split
from tidemark.plans import registry, training
from tidemark.sinks.files import save_model, write_layer
from tidemark.sources.files import load_model


def probability():
    return vector_to_array("probability")[1].alias("p")


@pytest.fixture(scope="module")
def prepared(spark):
    return training.prepare(planted(spark, 3000), keep=S.IDS)


@pytest.fixture(scope="module")
def table(prepared):
    return forest.numbered(forest.gathered(prepared.profiles, prepared.encoding), prepared.weights)


def test_a_grid_fits_every_candidate_on_all_rows(spark, tmp_path):
    """More rows than the 5,000 that the whole grid once drew for each candidate."""
    gold, out = planted(spark, 9000), str(tmp_path / "out")
    wanted = [
        models.Candidate("rf", "random_forest", {"n_estimators": 3, "max_depth": 12}),
        models.Candidate(
            "gb", "gradient_boosting", {"n_estimators": 50, "learning_rate": 0.1, "max_depth": 1}
        ),
    ]
    assert forest.in_tasks(wanted[0]) and boosting.in_tasks(wanted[1])
    board = training.train_grid(gold, out, wanted)
    rows = training.prepare(gold).train_rows
    assert rows > 7000
    for run in registry.read_runs(spark, f"{out}/runs").collect():
        nodes = spark.read.parquet(f"{run['uri']}/stages/3_*/data").filter("nodeData.id = 0")
        roots = [r[0] for r in nodes.select("nodeData.rawCount").collect()]
        trees = {"rf": 3, "gb": 50}[run["run_name"]]
        assert len(roots) == trees and all(abs(r - rows) < 5 * rows**0.5 for r in roots)
        assert run["roc_auc"] > 0.74 and len(load_model(run["uri"]).stages[-1].treeWeights) == trees
    assert board.count() == 2
    with pytest.raises(TypeError):
        training.train_grid(gold, out, wanted, fit_rows=5000)


def test_boosting_in_a_task_equals_spark_ml(spark, prepared, table, tmp_path):
    params = {"n_estimators": 6, "learning_rate": 0.2, "max_depth": 3}
    long = models.Candidate("gb", "gradient_boosting", params)
    model = models.assemble(
        prepared.encoding, boosting.stump(long, prepared.train_rows, prepared.splits, 15)
    )
    save_model(model, str(tmp_path / "gb"))
    nodes = boosting.tree_rows(spark, spark.sparkContext.broadcast(table), [long])
    write_layer(boosting.saved_rows(nodes, 0, 6), forest.nodes_path(str(tmp_path / "gb"), model))
    saved, plain = load_model(str(tmp_path / "gb")).stages[-1], training.fit(prepared, long)
    assert list(saved.treeWeights) == list(plain.treeWeights)
    assert saved.numFeatures == plain.numFeatures == 15
    one, other = (
        {r[0]: r[1] for r in m.transform(prepared.test).select("AppointmentID", probability()).collect()}
        for m in (saved, plain)
    )
    assert one.keys() == other.keys() and max(abs(one[k] - other[k]) for k in other) < 1e-9


def test_scores_of_saved_trees_are_the_loaded_forests(spark, prepared, table, tmp_path):
    deep = models.Candidate("rf", "random_forest", {"n_estimators": 20, "max_depth": None})
    path, context = str(tmp_path / "rf"), spark.sparkContext
    empty = forest.stump(deep, prepared.train_rows, prepared.splits, 15)
    model = models.assemble(prepared.encoding, empty)
    save_model(model, path)
    write_layer(forest.tree_rows(spark, context.broadcast(table), deep), forest.nodes_path(path, model))
    test = context.broadcast(forest.gathered(prepared.test_profiles, prepared.encoding))
    scored = forest.scores(spark, forest.nodes_path(path, model), test, 0, 20)
    loaded = load_model(path).stages[-1]
    assert (loaded.getNumTrees, loaded.getMaxDepth()) == (20, 30)
    plain = loaded.transform(prepared.test_folded).select(S.LABEL, probability(), split.ROWS)
    one = sorted(map(tuple, scored.select("label", "p", split.ROWS).collect()))
    other = sorted(map(tuple, plain.collect()))
    assert np.allclose(one, other, atol=1e-12)
    spark_ml = training.fit(prepared, deep).totalNumNodes
    assert 0.9 < loaded.totalNumNodes / spark_ml < 1.1


def test_a_stump_of_all_features_is_the_best_split(table):
    """The tree's first split against every split of the picked features, tried one by one."""
    no, yes = (np.where(table["yes"] == side, 1.0, 0.0) for side in (False, True))
    rows = (np.arange(len(no)), no, yes, np.zeros(len(no), np.int64))
    counts = tuple(np.array([c.sum()]) for c in (no, yes))
    for picked in ([0, 7, 13], [6, 12, 14]):
        best = forest.best_splits(table, rows, counts, np.array([picked]))
        w0, w1 = table["weights"]
        tried = []
        for feature in picked:
            for cut in range(table["widths"][feature] - 1):
                low = table["bins"][:, feature] <= cut
                parts = [(no[s].sum() * w0, yes[s].sum() * w1) for s in (low, ~low)]
                spread = sum(sum(p) * forest.gini(*p) for p in parts) / sum(map(sum, parts))
                tried.append(best["impurity"][0] - spread)
        assert best["gain"][0] == pytest.approx(max(tried))


def test_sorted_and_counted_values_give_the_same_splits(table, monkeypatch):
    grown = [forest.grown(table, 42, 1, 30)]
    monkeypatch.setattr(forest, "WIDE", 1)
    grown.append(forest.grown(table, 42, 1, 30))
    assert len(grown[0]["id"]) > 100
    for name in grown[0]:
        assert np.array_equal(grown[0][name], grown[1][name])


def test_with_too_many_profiles_spark_ml_fits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(forest, "MOST_PROFILES", 10)
    out = str(tmp_path / "out")
    wanted = [models.Candidate("rf", "random_forest", {"n_estimators": 2, "max_depth": 11})]
    training.train_grid(planted(spark, 500), out, wanted)
    (run,) = registry.read_runs(spark, f"{out}/runs").collect()
    assert load_model(run["uri"]).stages[-1].getNumTrees == 2

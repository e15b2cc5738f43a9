import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators import features, metrics, models, scoring, split
from tidemark.plans import inference, training
from tidemark.sources.files import load_model, read_requests


def planted(spark, n=6000):
    """Gold rows whose label follows a known logistic function of age and messages."""
    chance = "1 / (1 + exp(-(0.06 * (Age - 45) + 1.2 * sms_received_flag - 0.6)))"
    return (
        spark.range(n)
        .selectExpr(
            "cast(id AS double) AS PatientId",
            "id AS AppointmentID",
            "if(pmod(hash(id, 1), 2) = 0, 'Female', 'Male') AS Gender",
            "cast(pmod(hash(id, 2), 91) AS int) AS Age",
            "'X' AS Neighbourhood",
            "cast(pmod(hash(id, 3), 2) AS int) AS Scholarship",
            "cast(pmod(hash(id, 4), 2) AS int) AS Hipertension",
            "cast(pmod(hash(id, 5), 2) AS int) AS Diabetes",
            "cast(pmod(hash(id, 6), 2) AS int) AS Alcoholism",
            "cast(pmod(hash(id, 7), 5) AS int) AS Handcap",
            "cast(pmod(hash(id, 8), 2) AS int) AS sms_received_flag",
            "cast(pmod(hash(id, 9), 30) AS int) AS days_until_appointment",
            "pmod(hash(id, 10), 1000000) / 1000000D AS u",
        )
        .selectExpr("*", "Hipertension + Diabetes AS chronic_disease_count")
        .withColumn(
            "age_group",
            F.expr(
                "CASE WHEN Age < 18 THEN 'child' WHEN Age < 40 THEN 'young_adult' "
                "WHEN Age < 65 THEN 'adult' ELSE 'senior' END"
            ),
        )
        .withColumn("no_show", F.expr(f"cast(u < {chance} AS int)"))
        .select(*S.GOLD)
    )


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("planted") / "gold")
    planted(spark).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def prepared(spark, gold):
    return training.prepare(gold, keep=S.IDS)


def test_the_grid_is_five_of_each_family():
    assert len(models.GRID) == 15 and len({c.run_name for c in models.GRID}) == 15
    kinds = [c.model_type for c in models.GRID]
    assert [kinds.count(k) for k in models.BUILDERS] == [5, 5, 5]
    assert [c.params["C"] for c in models.GRID[:5]] == [0.01, 0.1, 1, 10, 100]
    assert models.GRID[9].params == {"n_estimators": 500, "max_depth": None}


def test_the_factory_sets_what_each_family_needs(spark):
    forest = models.estimator("random_forest", {"n_estimators": 500, "max_depth": None}, 10)
    assert forest.getMaxDepth() == 30 and forest.getNumTrees() == 500
    assert forest.getWeightCol() == "class_weight" and forest.getFeatureSubsetStrategy() == "sqrt"
    boosted = models.estimator(
        "gradient_boosting", {"n_estimators": 7, "learning_rate": 0.2, "max_depth": 3}, 10
    )
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth()) == (7, 0.2, 3)
    assert not boosted.isSet("weightCol")
    assert models.estimator("logistic_regression", {"C": 4}, 50).getRegParam() == 1 / 200


def test_the_factory_refuses_unknown_types(spark):
    with pytest.raises(ValueError, match="svm"):
        models.estimator("svm", {}, 1)


def test_unseen_levels_encode_to_zeros(spark, gold):
    encoding = models.encoder().fit(gold)
    odd = gold.limit(1).withColumns({"Gender": F.lit("?"), "age_group": F.lit("elder")})
    known = encoding.transform(gold).select(vector_to_array("features").alias("f")).first()[0]
    unseen = encoding.transform(odd).select(vector_to_array("features").alias("f")).first()[0]
    assert len(known) == len(unseen) == 2 + 4 + 9
    assert sum(known[:6]) == 2 and sum(unseen[:6]) == 0


def test_regression_equals_newton(spark, prepared):
    """Same objective solved directly: half the squared norm plus C times the weighted loss."""
    c = 0.1
    rows = prepared.train.select(vector_to_array("features"), S.LABEL, "class_weight").collect()
    x = np.array([r[0] for r in rows])
    y = np.array([r[1] for r in rows], dtype=float)
    w = np.array([r[2] for r in rows])
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(x1.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x1 @ beta))
        gradient = ridge @ beta + c * x1.T @ (w * (p - y))
        hessian = ridge + c * (x1 * (w * p * (1 - p))[:, None]).T @ x1
        beta -= np.linalg.solve(hessian, gradient)
    fitted = training.fit(prepared, models.Candidate("r", "logistic_regression", {"C": c}))
    expected = 1 / (1 + np.exp(-x1 @ beta))
    got = 1 / (1 + np.exp(-(x @ fitted.coefficients.toArray() + fitted.intercept)))
    assert np.abs(got - expected).max() < 1e-6
    assert np.allclose(fitted.coefficients.toArray(), beta[:-1], atol=1e-6)
    other = training.fit(prepared, models.Candidate("r", "logistic_regression", {"C": 1}))
    assert not np.allclose(other.coefficients.toArray(), beta[:-1], atol=1e-6)


@pytest.mark.parametrize(
    "candidate",
    [
        models.Candidate("lr", "logistic_regression", {"C": 1}),
        models.Candidate("rf", "random_forest", {"n_estimators": 20, "max_depth": 6}),
        models.Candidate(
            "gb", "gradient_boosting", {"n_estimators": 10, "learning_rate": 0.1, "max_depth": 3}
        ),
    ],
    ids=lambda c: c.run_name,
)
def test_every_family_finds_the_planted_signal(prepared, candidate):
    classifier = training.fit(prepared, candidate)
    row = training.grid_metrics(
        training.score_all(prepared.test, [candidate], [classifier]), [candidate]
    ).first()
    assert row["rows"] == 1200
    assert row["roc_auc"] > 0.78 and row["accuracy"] > 0.68


TREES = [
    models.Candidate("rf", "random_forest", {"n_estimators": 12, "max_depth": 7}),
    models.Candidate(
        "gb", "gradient_boosting", {"n_estimators": 8, "learning_rate": 0.1, "max_depth": 3}
    ),
]


def fitted_scores(spark, path, candidates=TREES):
    prepared = training.prepare(spark.read.parquet(path), keep=S.IDS)
    scores = training.score_all(
        prepared.test, candidates, training.fit_all(prepared, candidates), keep=S.IDS
    )
    return {(r["run_name"], r["AppointmentID"]): r["p"] for r in scores.collect()}


def test_trees_are_the_same_for_the_same_rows_in_other_files(spark, gold, tmp_path):
    """One file and six, whose rows stand elsewhere and in another order, a third being copies."""
    copies = gold.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2500)))).drop("n")
    rows = gold.unionByName(copies)
    paths = [str(tmp_path / "one"), str(tmp_path / "six")]
    rows.coalesce(1).write.parquet(paths[0])
    rows.orderBy(F.rand(3)).repartition(6).write.parquet(paths[1])
    one, six = (fitted_scores(spark, path) for path in paths)
    assert one.keys() == six.keys() and len(set(one.values())) > 100
    forest = [key for key in one if key[0] == "rf"]
    assert [one[k] for k in forest] == [six[k] for k in forest]
    assert max(abs(one[k] - six[k]) for k in one) < 1e-12


def test_rows_in_fixed_order_are_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(split, "COPIES_PER_CHUNK", 10)
    rows = [(i % 7, str(i % 3), 0.5) for i in range(200)] + [(1, None, None)] * 95
    df = spark.createDataFrame(rows, "a int, b string, c double")
    monkeypatch.setattr(split, "fixed_partitions", lambda n: 4)
    placed = [
        split.in_fixed_order(d, len(rows)).withColumn("at", F.spark_partition_id())
        for d in (df.coalesce(1), df.orderBy(F.rand(1)).repartition(9))
    ]
    first, again = ([tuple(r) for r in d.collect()] for d in placed)
    assert first == again and len({r[-1] for r in first}) > 1
    assert sorted(map(str, (r[:-1] for r in first))) == sorted(map(str, rows))


@pytest.mark.parametrize("rows, wanted", [(0, 1), (1, 1), (20_001, 2), (10**7, 200), (10**10, 5000)])
def test_fixed_partitions_follow_the_rows(rows, wanted):
    assert split.fixed_partitions(rows) == wanted


def test_exact_weights_sum_alike_in_any_order():
    weights = split.exact_weights({0: 0.6261, 1: 2.4833}, 1_000_000)
    assert weights[0] == pytest.approx(0.6261, rel=1e-8)
    drawn = [weights[i % 3 == 0] * (1 + i % 5) for i in range(100_000)]
    assert sum(drawn) == sum(reversed(drawn)) == sum(sorted(drawn))


def test_splits_tell_all_values_apart(spark, gold):
    assert models.splits_needed(gold) == 92  # ages 0 to 90
    wide = gold.withColumn("days_until_appointment", F.col("AppointmentID").cast("int") * 5)
    assert models.splits_needed(wide) == models.MOST_SPLITS
    assert models.splits_needed(gold.limit(0)) == 32


def test_first_rounds_equal_a_shorter_fit(spark, prepared, tmp_path):
    def boosted(rounds, rate=0.1):
        params = {"n_estimators": rounds, "learning_rate": rate, "max_depth": 3}
        return models.Candidate(f"gb_{rounds}_{rate}", "gradient_boosting", params)

    wanted = [boosted(6), boosted(2), boosted(4, 0.2), boosted(4)]
    assert sorted(map(sorted, training.families(wanted))) == [[0, 1, 3], [2]]
    together = training.fit_all(prepared, wanted)
    assert [m.getNumTrees for m in together] == [6, 2, 4, 4]
    for candidate, cut in zip(wanted, together):
        path = str(tmp_path / candidate.run_name)
        models.assemble(prepared.encoding, cut).write().save(path)
        alone = training.fit(prepared, candidate).transform(prepared.test)
        saved = load_model(path).stages[-1].transform(prepared.test)
        p = vector_to_array("probability")[1].alias("p")
        assert sorted(map(tuple, alone.select("AppointmentID", p).collect())) == sorted(
            map(tuple, saved.select("AppointmentID", p).collect())
        )
    with pytest.raises(ValueError, match="2 rounds"):
        models.first_rounds(together[1], 3)


def test_tree_nodes_predict_like_the_model(spark, prepared, tmp_path):
    """A saved forest's nodes as rows lead every test row to the model's probability."""
    candidate = models.Candidate("rf", "random_forest", {"n_estimators": 3, "max_depth": 4})
    forest, path = training.fit(prepared, candidate), str(tmp_path / "forest")
    forest.write().save(path)
    names = models.feature_names(prepared.encoding)
    nodes = {(r["tree"], r["node"]): r for r in models.tree_nodes(spark, path, names).collect()}
    rows = forest.transform(prepared.test).select(
        vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")
    )
    for x, p in rows.limit(200).collect():
        total = 0.0
        for tree in range(3):
            at = nodes[tree, 0]
            while at["feature"] is not None:
                low = x[names.index(at["feature"])] <= at["threshold"]
                at = nodes[tree, at["low"] if low else at["high"]]
            total += at["stats"][1] / sum(at["stats"])
        assert p == pytest.approx(total / 3)


def test_gradient_is_zero_at_the_fit_and_not_beside_it(spark, prepared):
    fitted = training.fit(prepared, models.Candidate("r", "logistic_regression", {"C": 0.01}))
    row = models.loss_gradient(fitted, prepared.train).first()
    coefficients = [*fitted.coefficients.toArray(), 0.0]
    assert row["scale"][:-1] == [1.0] * 6 + [90.0, 1, 1, 1, 1, 4, 1, 29, 2]
    for c, zero in ((0.01, True), (0.02, False)):
        gradient = [g + b / (c * prepared.train_rows) for g, b in zip(row["gradient"], coefficients)]
        assert (max(abs(g / s) for g, s in zip(gradient, row["scale"])) < 1e-7) == zero


def test_scoring_many_reads_once_and_equals_scoring_each(spark, prepared):
    candidates = [
        models.Candidate("a", "logistic_regression", {"C": 1}),
        models.Candidate("b", "random_forest", {"n_estimators": 3, "max_depth": 3}),
    ]
    fitted = training.fit_all(prepared, candidates, parallelism=2)
    together = training.score_all(prepared.test, candidates, fitted, keep=S.IDS)
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    for candidate, classifier in zip(candidates, fitted):
        alone = classifier.transform(prepared.test).select(
            "AppointmentID", vector_to_array("probability")[1].alias("p")
        )
        both = together.filter(F.col("run_name") == candidate.run_name).select(
            "AppointmentID", "p"
        )
        assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, both.collect()))


def test_saved_model_scores_the_same(spark, prepared, gold, tmp_path):
    candidate = models.Candidate("a", "logistic_regression", {"C": 1})
    model = models.assemble(prepared.encoding, training.fit(prepared, candidate))
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    before = inference.batch_predictions(gold, model).collect()
    gold.write.parquet(str(tmp_path / "gold"))
    written = inference.run_batch_inference(
        spark, str(tmp_path / "gold"), path, str(tmp_path / "predictions")
    )
    assert written.columns == S.PREDICTIONS
    assert sorted(map(tuple, before)) == sorted(map(tuple, written.collect()))
    again = scoring.predict(features.scoring_set(gold), load_model(path))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, before))


def test_scoring_is_one_stage_without_python(spark, prepared, gold):
    candidate = models.Candidate("a", "logistic_regression", {"C": 1})
    model = models.assemble(prepared.encoding, training.fit(prepared, candidate))
    plan = inference.batch_predictions(gold, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_serving_threshold_is_inclusive(spark):
    rows = spark.createDataFrame(
        [(0.2999999,), (0.30,), (0.5,), (0.5000001,)], "no_show_probability double"
    )
    assert [r[1] for r in scoring.decide(rows).collect()] == [0, 1, 1, 1]
    responses = scoring.responses(rows).collect()
    assert [r["prediction_label"] for r in responses] == ["Likely Show"] + ["Likely No-show"] * 3
    assert responses[0]["no_show_probability"] == 0.3 and responses[0]["predicted_no_show"] == 0
    assert responses[0]["threshold"] == 0.30


def test_train_one_records_two_metrics(spark, gold, tmp_path):
    runs = str(tmp_path / "runs")
    candidate = models.Candidate("small", "random_forest", {"n_estimators": 3, "max_depth": 3})
    model, measured, report = training.train_one(
        gold, str(tmp_path / "model"), candidate, runs_path=runs
    )
    row = spark.read.parquet(runs).first()
    assert row["accuracy"] == measured.first()["accuracy"] and row["precision"] is None
    assert row["params"]["n_estimators"] == "3" and "Gender" in row["params"]["features"]
    assert report.count() == 5
    assert load_model(str(tmp_path / "model")).transform(gold).count() == gold.count()


def test_metrics_of_scores_without_probabilities(spark):
    rows = spark.createDataFrame(
        [("r", None, 1, 1), ("r", 0.2, 0, 0)], "run string, s double, c int, label int"
    ).withColumn("p", C.score_or_class("s", "c"))
    assert metrics.run_metrics(rows, ["run"]).first()["roc_auc"] == 1.0


def test_requests_need_features_only(spark, prepared, gold, tmp_path):
    candidate = models.Candidate("a", "logistic_regression", {"C": 1})
    model = models.assemble(prepared.encoding, training.fit(prepared, candidate))
    path = str(tmp_path / "requests")
    gold.select(*S.FEATURES).limit(5).write.json(path)
    requests = read_requests(spark, path)
    assert requests.schema == S.request_schema()
    rows = inference.respond(requests, model, keep=["Age"]).collect()
    assert len(rows) == 5
    for row in rows:
        assert row["predicted_no_show"] == int(row["no_show_probability"] >= 0.3)
        assert row["threshold"] == 0.3
    (tmp_path / "bad.json").write_text('{"Gender": "Female", "Age": "old"}')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_requests(spark, str(tmp_path / "bad.json")).collect()


def test_equal_rows_are_folded_for_learners_that_draw_none(spark, gold):
    """Every profile once with the number of its copies, and the model of the rows."""
    twice = gold.unionByName(gold.withColumn("AppointmentID", F.col("AppointmentID") + 10_000_000))
    few = twice.withColumns(
        {
            "Age": (F.col("Age") / 30).cast("int") * 30,
            "days_until_appointment": F.col("days_until_appointment") % 2,
            "Handcap": F.col("Handcap") % 2,
        }
    )
    prepared = training.prepare(few, keep=S.IDS)
    folded = prepared.train_folded
    assert folded.agg(F.sum(split.ROWS)).first()[0] == prepared.train_rows
    assert folded.count() == prepared.rows("train").select(*S.TRAINING).distinct().count()
    assert folded.count() < prepared.train_rows / 2
    assert prepared.test_folded.agg(F.sum(split.ROWS)).first()[0] == prepared.test.count()
    for candidate in (TREES[1], models.Candidate("lr", "logistic_regression", {"C": 1})):
        fitted = training.fit(prepared, candidate)
        built = models.estimator(
            candidate.model_type, candidate.params, prepared.train_rows, splits=prepared.splits
        )
        plain = built.fit(prepared.train)
        scores = [
            training.score_all(prepared.test, [candidate], [m], keep=["AppointmentID"])
            for m in (fitted, plain)
        ]
        one, other = ({r["AppointmentID"]: r["p"] for r in s.collect()} for s in scores)
        assert max(abs(one[k] - other[k]) for k in other) < 1e-6
        whole = training.grid_metrics(scores[0], [candidate]).first()
        short = training.score_all(prepared.test_folded, [candidate], [fitted], keep=[split.ROWS])
        assert training.grid_metrics(short, [candidate]).first() == whole


def test_rows_travel_once_to_the_places_of_their_chunks(spark, monkeypatch):
    rows = [(i % 40, str(i % 3), None if i % 5 else 0.5) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(3)
    monkeypatch.setattr(split, "fixed_partitions", lambda n: 4)

    def placed():
        ordered = split.in_fixed_order(df, len(rows)).withColumn("at", F.spark_partition_id())
        plan = ordered._jdf.queryExecution().optimizedPlan().toString()
        return "Aggregate" in plan, [tuple(r) for r in ordered.collect()]

    assert not split.may_crowd(df)
    counted, once = placed()
    monkeypatch.setattr(split, "may_crowd", lambda d: True)
    assert (counted, placed()) == (False, (True, once))


def test_a_large_forest_on_few_rows_is_built_in_parts(spark, prepared, tmp_path):
    wanted = models.Candidate("rf", "random_forest", {"n_estimators": 120, "max_depth": 3})
    parts = prepared.parts(wanted)
    assert [(p.params["n_estimators"], p.params["seed"]) for p in parts] == [(50, 42), (50, 43), (20, 44)]
    small = models.Candidate("rf", "random_forest", {"n_estimators": 50, "max_depth": 3})
    assert prepared.parts(small) == [small]
    whole = training.fit_all(prepared, [wanted])[0]
    assert whole.getNumTrees == 120 and len({t.toDebugString for t in whole.trees}) > 100
    path = str(tmp_path / "whole")
    models.assemble(prepared.encoding, whole).write().save(path)
    saved = load_model(path).stages[-1]
    p = vector_to_array("probability")[1].alias("p")
    rows = [m.transform(prepared.test).select("AppointmentID", p) for m in (whole, saved)]
    first = training.fit_part(prepared, small)
    own = {tuple(t.toDebugString.splitlines()[1:]) for t in first.trees}
    assert own <= {tuple(t.toDebugString.splitlines()[1:]) for t in whole.trees}
    one, other = (sorted(map(tuple, r.collect())) for r in rows)
    assert one == other
    fitted = training.fit(prepared, wanted).transform(prepared.test).select("AppointmentID", p)
    assert sorted(map(tuple, fitted.collect())) == one


def test_flat_forests_keep_no_node_ids(spark):
    flat, deep = (
        models.estimator("random_forest", {"n_estimators": 2, "max_depth": d}, 10) for d in (5, 12)
    )
    assert (flat.getCacheNodeIds(), deep.getCacheNodeIds()) == (False, True)

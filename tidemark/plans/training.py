"""Train, compare, select and register."""

import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import boosting, features, forest, metrics, models, ranking, split
from tidemark.plans import registry
from tidemark.session import scratch_path, shared_folder
from tidemark.sinks.files import save_model, write_layer, write_leaderboard_csv
from tidemark.sources.files import load_model, read_layer

DRAWS = 1 << 20  # steps of a drawn share


@dataclass(frozen=True)
class Prepared:
    """Split rows, written once, and what was learnt from their training part."""

    spark: SparkSession
    split_rows: DataFrame
    keep: list[str]
    encoding: PipelineModel
    weights: dict
    train_rows: int
    splits: int
    fit_rows: int | None = None

    def rows(self, part: str) -> DataFrame:
        """Plain rows of ``train`` or ``test``: a scan with a test of the row's hash."""
        unwanted = [c for c in S.IDS if c not in self.keep]
        return self.split_rows.filter(F.col("split") == part).drop("split", *unwanted)

    @property
    def fitted_rows(self) -> DataFrame:
        """Plain rows that classifiers are fitted on, ids included."""
        rows = self.split_rows.filter(F.col("split") == "train").drop("split")
        if self.fit_rows is not None and self.fit_rows < self.train_rows:
            draw = F.pmod(F.xxhash64(*S.IDS), F.lit(DRAWS))
            rows = rows.filter(draw < int(DRAWS * self.fit_rows / self.train_rows))
        return rows

    def encoded(self, rows: DataFrame, weights: dict) -> DataFrame:
        weighted = split.with_class_weight(rows, weights)
        return self.encoding.transform(weighted).select("features", S.LABEL, "class_weight")

    @property
    def train(self) -> DataFrame:
        """Encoded and weighted. Encoding is narrow and the vectors are wider than the rows,
        so every fit encodes as it reads; Spark ML keeps its own working copy."""
        return self.encoded(self.fitted_rows, self.weights)

    @property
    def fitted_count(self) -> int:
        """Rows that classifiers are fitted on, about."""
        return min(self.train_rows, self.fit_rows or self.train_rows)

    def parts(self, candidate: models.Candidate) -> list[models.Candidate]:
        """Fits that make up the candidate's. Rows of a single partition keep one task busy,
        so a large forest on them is several smaller ones that are built side by side."""
        if split.fixed_partitions(self.fitted_count) > 1:
            return [candidate]
        return models.forest_parts(candidate)

    @cached_property
    def in_fixed_order(self) -> DataFrame:
        """``fitted_rows`` in partitions and an order that their values alone decide."""
        return split.in_fixed_order(self.fitted_rows, self.fitted_count)

    @property
    def train_for_trees(self) -> DataFrame:
        """As ``train``, for learners that draw rows by partition and position.

        Weights are such that their sums are exact, so a forest is the same for the same rows
        in any files and on any cluster.
        """
        return self.encoded(
            self.in_fixed_order, split.exact_weights(self.weights, self.train_rows)
        )

    @cached_property
    def profiles(self) -> DataFrame:
        """``fitted_rows`` without ids, each distinct one once with the number of its copies."""
        return split.profiles_in_fixed_order(
            self.fitted_rows.select(*S.TRAINING), self.fitted_count
        )

    @property
    def train_folded(self) -> DataFrame:
        """As ``train``, for learners to whom equal rows are one row with their summed weight.

        Features have few values, so a large table has far fewer profiles than rows, and what
        such a learner keeps and passes over in every step grows with those.
        """
        weighted = split.with_class_weight(self.profiles, self.weights).withColumn(
            "class_weight", F.col("class_weight") * F.col(split.ROWS)
        )
        return self.encoding.transform(weighted).select(
            "features", S.LABEL, "class_weight", split.ROWS
        )

    @property
    def test(self) -> DataFrame:
        return self.encoding.transform(self.rows("test"))

    @cached_property
    def test_profiles(self) -> DataFrame:
        """Plain distinct rows of the test part with the number of their copies."""
        rows = self.split_rows.filter(F.col("split") == "test").select(*S.TRAINING)
        return split.profiles(rows)

    @property
    def test_folded(self) -> DataFrame:
        """The test part's profiles, encoded, with the number of their copies."""
        return self.encoding.transform(self.test_profiles)

    @cached_property
    def fits_a_task(self) -> bool:
        """Whether a task can hold the profiles of either part."""
        return max(self.profiles.count(), self.test_profiles.count()) <= forest.MOST_PROFILES


def prepare(
    gold_df: DataFrame,
    keep: list[str] | None = None,
    fraction: float = S.TEST_FRACTION,
    seed: int = S.SEED,
    fit_rows: int | None = None,
) -> Prepared:
    """Split the training rows; learn encoding and weights.

    Rows are told apart by ids and features together, so the many patients of one profile
    are spread over both parts like any others; ids not in ``keep`` are dropped afterwards.
    Encoding and weights come from the training part alone, and once for all candidates.
    ``fit_rows`` bounds the labelled rows a classifier is fitted on (about so many, drawn by
    the hash of their ids); by default it is fitted on all.
    """
    spark = gold_df.sparkSession
    rows = features.training_set(gold_df, S.IDS)
    split_rows = split.stratified_split(rows, fraction=fraction, seed=seed, key=rows.columns)
    train = split_rows.filter(F.col("split") == "train")
    classes = split.per_class(split.class_weights(train), S.LABEL)
    return Prepared(
        spark,
        split_rows,
        keep or [],
        models.encoder().fit(train),
        {label: row["class_weight"] for label, row in classes.items()},
        sum(row["class_rows"] for row in classes.values()),
        models.splits_needed(train),
        fit_rows,
    )


def fit(prepared: Prepared, candidate: models.Candidate):
    """One fitted classifier over the prepared features."""
    return models.joined_forest([fit_part(prepared, part) for part in prepared.parts(candidate)])


def fit_part(prepared: Prepared, candidate: models.Candidate):
    shared_folder(prepared.spark)  # boosted and deep trees cut their lineage there
    # Spark ML looks for splits in a sample of about their square if there are more rows.
    splits = max(prepared.splits, math.isqrt(prepared.train_rows) + 1)
    built = models.estimator(
        candidate.model_type, candidate.params, prepared.train_rows, splits=splits
    )
    if candidate.model_type in models.DRAWS_ROWS:
        fitted = built.fit(prepared.train_for_trees)
    else:
        if not built.isSet("weightCol"):
            built.setWeightCol(split.ROWS)
        fitted = built.fit(prepared.train_folded)
    if getattr(fitted, "hasSummary", False):
        # It would carry the session along into every task that scores.
        fitted._java_obj.setSummary(prepared.spark._jvm.scala.Option.empty())
    return fitted


def families(candidates: list[models.Candidate]) -> list[list[int]]:
    """Positions of candidates that one fit serves, each family's longest fit last."""
    found: dict = {}
    for seq, candidate in enumerate(candidates):
        found.setdefault(models.shares_fit(candidate) or seq, []).append(seq)
    return [
        sorted(family, key=lambda seq: candidates[seq].params.get("n_estimators", 0))
        for family in found.values()
    ]


def fit_all(prepared: Prepared, candidates: list[models.Candidate], parallelism: int = 4) -> list:
    """Every candidate on the same rows, a few at a time so that the cluster stays busy.

    Boosted candidates that differ in rounds alone are fitted once and cut; large forests on few
    rows are fitted in parts, see ``Prepared.parts``, and joined.
    """
    related = families(candidates)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        jobs = [
            [
                pool.submit(inheritable_thread_target(prepared.spark)(fit_part), prepared, part)
                for part in prepared.parts(candidates[family[-1]])
            ]
            for family in related
        ]
        fitted: dict = {}
        for family, parts in zip(related, jobs):
            longest = models.joined_forest([part.result() for part in parts])
            for seq in family[:-1]:
                rounds = candidates[seq].params["n_estimators"]
                fitted[seq] = models.first_rounds(longest, rounds)
            fitted[family[-1]] = longest
    return [fitted[seq] for seq in range(len(candidates))]


def score_all(
    test: DataFrame,
    candidates: list[models.Candidate],
    classifiers: list,
    keep: list[str] | None = None,
    seqs: list[int] | None = None,
) -> DataFrame:
    """Scores of all candidates in one long frame: seq, run_name, model_type, label, p.

    ``seqs`` are the candidates' positions, by default from 0.

    The test rows are read once; every classifier adds its column and the columns are
    then unfolded into rows.
    """
    wide, scores = test, []
    for seq, candidate, classifier in zip(seqs or range(len(candidates)), candidates, classifiers):
        column = f"_probability_{seq}"
        quiet = classifier.copy()
        quiet.setRawPredictionCol("").setPredictionCol("").setProbabilityCol(column)
        wide = quiet.transform(wide)
        scores.append(
            F.struct(
                F.lit(seq).alias("seq"),
                F.lit(candidate.run_name).alias("run_name"),
                F.lit(candidate.model_type).alias("model_type"),
                vector_to_array(F.col(column))[1].alias("p"),
            )
        )
    return wide.select(
        *(keep or []), F.col(S.LABEL).alias("label"), F.explode(F.array(*scores)).alias("_s")
    ).select(*(keep or []), "_s.seq", "_s.run_name", "_s.model_type", "label", "_s.p")


def grid_metrics(
    scored: DataFrame, candidates: list[models.Candidate], seqs: list[int] | None = None
) -> DataFrame:
    """Metrics per candidate; ``seqs`` are their positions, by default from 0.

    Only the position travels with the scores; names join the measured rows, of which
    there is one per candidate. Scores of profiles carry the number of their copies.
    """
    names = scored.sparkSession.createDataFrame(
        [
            (seq, c.run_name, c.model_type)
            for seq, c in zip(seqs or range(len(candidates)), candidates)
        ],
        "seq int, run_name string, model_type string",
    )
    rows = [c for c in scored.columns if c == split.ROWS]
    measured = metrics.run_metrics(
        scored.select("seq", "label", "p", *rows), ["seq"], rows=next(iter(rows), None)
    )
    return measured.join(F.broadcast(names), "seq").select(
        "seq", "run_name", "model_type", *measured.columns[1:]
    )


def params_text(params: dict) -> dict[str, str | None]:
    return {
        key: None if value is None else str(value)
        for key, value in models.in_force(params).items()
    }


def train_grid(
    gold_df: DataFrame,
    out: str,
    candidates: list[models.Candidate] | None = None,
    experiment: str = S.EXPERIMENT,
    name: str = S.MODEL_NAME,
    metric: str = S.SELECTION_METRIC,
    parallelism: int = 4,
    select: bool = True,
) -> DataFrame:
    """Fit and compare the candidates, record every run, register the best; the leaderboard.

    Below ``out``: ``models/<run_id>``, ``runs``, ``registry`` and ``leaderboard`` (CSV).
    With ``select=False`` the candidates are only compared and recorded. ``parallelism``
    fits are made, saved, scored and released together, so the driver never holds more
    models than that; boosted candidates that differ in rounds alone share a fit. Large forests
    are grown, saved and scored by the tasks, see ``forest``, and the driver holds none of their
    trees. Every candidate is fitted on all training rows. The rows that trees draw from are put
    in their order once and held by the executors, on disk where memory ends, until the grid is
    done.
    """
    spark = gold_df.sparkSession
    candidates = candidates or models.GRID
    prepared = prepare(gold_df)
    held = [prepared.profiles, prepared.test_profiles]
    for rows in held:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        grown = [
            seq
            for seq, c in enumerate(candidates)
            if (forest.in_tasks(c) or boosting.in_tasks(c)) and prepared.fits_a_task
        ]
        others = [seq for seq in range(len(candidates)) if seq not in grown]
        if any(candidates[seq].model_type in models.DRAWS_ROWS for seq in others):
            held.append(prepared.in_fixed_order)
            prepared.in_fixed_order.persist(StorageLevel.MEMORY_AND_DISK)
        records = _grid_runs(prepared, out, candidates, others, experiment, parallelism)
        if grown:
            records += _grown_runs(prepared, out, candidates, grown, experiment, parallelism)
    finally:
        for rows in held:
            rows.unpersist()
    ids = [record[2] for record in records]
    runs = registry.read_runs(spark, f"{out}/runs").filter(F.col("run_id").isin(ids))
    board = ranking.leaderboard(runs, metric)
    names = list(dict.fromkeys(key for c in candidates for key in c.params))
    write_leaderboard_csv(board, f"{out}/leaderboard", names)
    if select:
        best = ranking.best_run(runs, metric).first()
        if best is None:
            raise ValueError(f"no run has a {metric}: the test part may hold one class only")
        registry.register(spark, f"{out}/registry", best["run_id"], best["uri"], name)
    return board


def _record(seq: int, candidate: models.Candidate, out: str, experiment: str) -> tuple:
    """A run's position, experiment, id, parameters and artifact."""
    run_id = uuid.uuid4().hex
    return seq, experiment, run_id, params_text(candidate.params), f"{out}/models/{run_id}"


def _append_runs(scored: DataFrame, group: list[models.Candidate], own: list, out: str) -> None:
    """Measure the scores of the recorded runs. Ids are drawn per call: append first, then rank
    what was appended."""
    recorded = scored.sparkSession.createDataFrame(
        own,
        "seq int, experiment string, run_id string, params map<string,string>, uri string",
    )
    measured = grid_metrics(scored, group, [record[0] for record in own])
    registry.append_runs(measured.join(F.broadcast(recorded), "seq"), f"{out}/runs")


def _grid_runs(
    prepared: Prepared,
    out: str,
    candidates: list[models.Candidate],
    wanted: list[int],
    experiment: str,
    parallelism: int,
) -> list[tuple]:
    """Fit, save, score and record the candidates ``wanted``, ``parallelism`` fits at a time."""

    def saved_again(classifier, uri: str):
        return load_model(save_model(models.assemble(prepared.encoding, classifier), uri)).stages[-1]

    records = []
    related = [[wanted[i] for i in family] for family in families([candidates[i] for i in wanted])]
    for first in range(0, len(related), parallelism):
        seqs = sorted(seq for family in related[first : first + parallelism] for seq in family)
        group = [candidates[seq] for seq in seqs]
        own = [_record(seq, candidates[seq], out, experiment) for seq in seqs]
        fitted = fit_all(prepared, group, parallelism)
        # The saved artifacts are scored, and the group's models go before the next group's.
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            again = inheritable_thread_target(prepared.spark)(saved_again)
            jobs = [pool.submit(again, model, record[4]) for model, record in zip(fitted, own)]
            saved = [job.result() for job in jobs]
        scored = score_all(prepared.test_folded, group, saved, keep=[split.ROWS], seqs=seqs)
        _append_runs(scored, group, own, out)
        records += own
    return records


def _grown_runs(
    prepared: Prepared,
    out: str,
    candidates: list[models.Candidate],
    wanted: list[int],
    experiment: str,
    parallelism: int,
) -> list[tuple]:
    """As ``_grid_runs`` for large forests and long boosting, whose trees the tasks grow."""
    spark = prepared.spark
    shared_folder(spark)
    rows = forest.numbered(forest.gathered(prepared.profiles, prepared.encoding), prepared.weights)
    features = len(rows["widths"])
    train = spark.sparkContext.broadcast(rows)
    test = spark.sparkContext.broadcast(forest.gathered(prepared.test_profiles, prepared.encoding))
    del rows
    group = [candidates[seq] for seq in wanted]
    records = [_record(seq, candidates[seq], out, experiment) for seq in wanted]

    def save(candidate: models.Candidate, record: tuple) -> str:
        """Everything of the artifact but its nodes; where those belong."""
        kind = forest if forest.in_tasks(candidate) else boosting
        empty = kind.stump(candidate, prepared.train_rows, prepared.splits, features)
        model = models.assemble(prepared.encoding, empty)
        save_model(model, record[4])
        return forest.nodes_path(record[4], model)

    def boost(found: list[list[int]]) -> DataFrame:
        longest = [group[family[-1]] for family in found]
        nodes = boosting.tree_rows(spark, train, longest)
        nodes = read_layer(spark, write_layer(nodes, scratch_path(spark, "boosted")))
        for fit, family in enumerate(found):
            for i in family:
                write_layer(boosting.saved_rows(nodes, fit, group[i].params["n_estimators"]), paths[i])
        chosen = [i for family in found for i in family]
        saved = [load_model(records[i][4]).stages[-1] for i in chosen]
        return score_all(
            prepared.test_folded,
            [group[i] for i in chosen],
            saved,
            keep=[split.ROWS],
            seqs=[wanted[i] for i in chosen],
        ).select("seq", "label", "p", split.ROWS)

    def grow(i: int) -> DataFrame:
        write_layer(forest.tree_rows(spark, train, group[i]), paths[i])
        return forest.scores(spark, paths[i], test, wanted[i], group[i].params["n_estimators"])

    def kept(make: Callable[..., DataFrame], argument) -> DataFrame:
        return read_layer(spark, write_layer(make(argument), scratch_path(spark, "scores")))

    along = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        saving = [pool.submit(along(save), c, record) for c, record in zip(group, records)]
        paths = [job.result() for job in saving]
        forests = [i for i, c in enumerate(group) if forest.in_tasks(c)]
        found = [f for f in families(group) if f[0] not in forests]
        jobs = [pool.submit(along(kept), boost, found)] if found else []
        jobs += [pool.submit(along(kept), grow, i) for i in forests]
        scored = [job.result() for job in jobs]
    _append_runs(reduce(DataFrame.unionByName, scored), group, records, out)
    for held in (train, test):
        held.destroy()
    return records


def train_one(
    gold_df: DataFrame,
    model_path: str,
    candidate: models.Candidate = models.BASELINE,
    runs_path: str | None = None,
    experiment: str = S.EXPERIMENT,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit, evaluate and save one model: the artifact, its metrics, its per-class report.

    With ``runs_path`` the run is also recorded, with accuracy and ROC AUC only.
    """
    prepared = prepare(gold_df)
    classifier = fit(prepared, candidate)
    model = models.assemble(prepared.encoding, classifier)
    save_model(model, model_path)
    scored = score_all(prepared.test, [candidate], [classifier])
    measured = grid_metrics(scored, [candidate])
    if runs_path:
        params = {**candidate.params, "features": S.FEATURES}
        record = prepared.spark.createDataFrame(
            [(0, experiment, uuid.uuid4().hex, params_text(params), model_path)],
            "seq int, experiment string, run_id string, params map<string,string>, uri string",
        )
        registry.append_runs(
            measured.drop("precision", "recall", "f1_score").join(F.broadcast(record), "seq"),
            runs_path,
        )
    return model, measured, metrics.classification_report(scored)

"""Encoding stages, estimators and the candidate grid."""

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S

UNLIMITED_DEPTH = 30  # the deepest tree Spark ML grows
PART_TREES = 50  # trees of a forest on few rows that are built by one fit
WALKED_DEPTH = 10  # up to here a forest's rows walk from the root at each level
# Candidate splits of a feature: as many as tell all its values apart, up to so many. Beyond
# that, which days up to 27 years ahead don't reach, neighbouring values share a split.
MOST_SPLITS = 10_000


@dataclass(frozen=True)
class Candidate:
    run_name: str
    model_type: str
    params: dict = field(hash=False)


# --- Fixed values: the candidates compared by default ---

GRID = [
    Candidate("lr_c_0_01", "logistic_regression", {"C": 0.01}),
    Candidate("lr_c_0_1", "logistic_regression", {"C": 0.1}),
    Candidate("lr_c_1", "logistic_regression", {"C": 1}),
    Candidate("lr_c_10", "logistic_regression", {"C": 10}),
    Candidate("lr_c_100", "logistic_regression", {"C": 100}),
    Candidate("rf_50_depth_5", "random_forest", {"n_estimators": 50, "max_depth": 5}),
    Candidate("rf_100_depth_8", "random_forest", {"n_estimators": 100, "max_depth": 8}),
    Candidate("rf_200_depth_10", "random_forest", {"n_estimators": 200, "max_depth": 10}),
    Candidate("rf_300_depth_12", "random_forest", {"n_estimators": 300, "max_depth": 12}),
    Candidate("rf_500_depth_none", "random_forest", {"n_estimators": 500, "max_depth": None}),
    Candidate(
        "gb_50_lr_0_1_depth_3",
        "gradient_boosting",
        {"n_estimators": 50, "learning_rate": 0.1, "max_depth": 3},
    ),
    Candidate(
        "gb_100_lr_0_1_depth_3",
        "gradient_boosting",
        {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3},
    ),
    Candidate(
        "gb_200_lr_0_1_depth_3",
        "gradient_boosting",
        {"n_estimators": 200, "learning_rate": 0.1, "max_depth": 3},
    ),
    Candidate(
        "gb_100_lr_0_05_depth_3",
        "gradient_boosting",
        {"n_estimators": 100, "learning_rate": 0.05, "max_depth": 3},
    ),
    Candidate(
        "gb_100_lr_0_2_depth_3",
        "gradient_boosting",
        {"n_estimators": 100, "learning_rate": 0.2, "max_depth": 3},
    ),
]
BASELINE = Candidate(
    "random_forest_baseline", "random_forest", {"n_estimators": 100, "max_depth": 8}
)

# --- End of fixed values ---


def encoder() -> Pipeline:
    """One-hot categories and plain numbers in ``features``.

    ``keep`` gives unknown levels a slot of their own and ``dropLast`` drops just that
    slot: every level seen in training has its column, an unseen one is all zeros.
    """
    index = [f"{c}_index" for c in S.CATEGORICAL]
    onehot = [f"{c}_onehot" for c in S.CATEGORICAL]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=S.CATEGORICAL,
                outputCols=index,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=True),
            VectorAssembler(inputCols=onehot + S.NUMERIC, outputCol="features"),
        ]
    )


def in_force(params: dict) -> dict:
    """Parameters as they act: a tree of unlimited depth stops at ``UNLIMITED_DEPTH``."""
    return {k: UNLIMITED_DEPTH if k == "max_depth" and v is None else v for k, v in params.items()}


def _logistic_regression(params: dict, rows: int, splits: int) -> Estimator:
    """L2 with inverse strength ``C`` on the summed loss.

    Spark divides the loss by the weight total, which for balanced weights is ``rows``.
    """
    return LogisticRegression(
        regParam=1.0 / (params["C"] * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
        tol=1e-10,
        weightCol="class_weight",
    )


def _random_forest(params: dict, rows: int, splits: int) -> Estimator:
    """``max_features`` (sqrt) and ``bootstrap`` (true) are optional."""
    return RandomForestClassifier(
        numTrees=params["n_estimators"],
        maxDepth=in_force(params)["max_depth"],
        maxBins=splits,
        featureSubsetStrategy=params.get("max_features", "sqrt"),
        bootstrap=params.get("bootstrap", True),
        weightCol="class_weight",
        # Late levels need not walk from the root; for a few levels the ids of every row and
        # tree cost more to keep than the walk. The trees are the same.
        cacheNodeIds=in_force(params)["max_depth"] > WALKED_DEPTH,
        seed=params.get("seed", S.SEED),
    )


def _gradient_boosting(params: dict, rows: int, splits: int) -> Estimator:
    return GBTClassifier(
        maxIter=params["n_estimators"],
        stepSize=params["learning_rate"],
        maxDepth=params["max_depth"],
        maxBins=splits,
        seed=S.SEED,
    )


BUILDERS = {
    "logistic_regression": _logistic_regression,
    "random_forest": _random_forest,
    "gradient_boosting": _gradient_boosting,
}


# Families that draw rows. The others take a profile with its number of copies for as many rows.
DRAWS_ROWS = {"random_forest"}


def splits_needed(train: DataFrame) -> int:
    """Splits that tell every value of every feature apart: features are whole numbers, so the
    widest one's span is enough. One aggregate; at least Spark's 32."""
    spans = [(F.max(c) - F.min(c) + 2) for c in S.NUMERIC]
    span = train.agg(F.greatest(*spans)).first()[0] or 0
    return min(max(span, 32), MOST_SPLITS)


def estimator(
    model_type: str, params: dict, rows: int, label: str = S.LABEL, splits: int = 512
) -> Estimator:
    """An unfitted classifier over ``features``; ``rows`` is the size of the training part.

    Trees try ``splits`` values of a feature at most, see ``splits_needed``.
    """
    if model_type not in BUILDERS:
        raise ValueError(f"{model_type!r} is none of {sorted(BUILDERS)}")
    built = BUILDERS[model_type](params, rows, splits)
    return built.setFeaturesCol("features").setLabelCol(label)


def shares_fit(candidate: Candidate):
    """What candidates have in common whose models are cuts of one fit.

    Boosting adds one tree after another, so fewer rounds at the same rate and depth are the
    first trees of more. None for a candidate that stands alone.
    """
    if candidate.model_type != "gradient_boosting":
        return None
    others = {k: v for k, v in candidate.params.items() if k != "n_estimators"}
    return (candidate.model_type, *sorted(others.items()))


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The boosted model as it was after so many rounds."""
    if rounds > model.getNumTrees:
        raise ValueError(f"the model has {model.getNumTrees} rounds, not {rounds}")
    java, jvm = model._java_obj, SparkSession.active().sparkContext._jvm
    trees = java.trees()
    own = SparkSession.active().sparkContext._gateway
    kept = own.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = own.new_array(own.jvm.double, rounds)
    for i in range(rounds):
        kept[i], weights[i] = trees[i], model.treeWeights[i]
    shorter = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_{rounds}", kept, weights
    )
    return model._copyValues(GBTClassificationModel(shorter))


def of_rounds(model: GBTClassificationModel, rounds: int, rate: float) -> GBTClassificationModel:
    """A boosted model so long whose trees are all the given one's first."""
    java, jvm = model._java_obj, SparkSession.active().sparkContext._jvm
    own = SparkSession.active().sparkContext._gateway
    kept = own.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = own.new_array(own.jvm.double, rounds)
    for i in range(rounds):
        kept[i], weights[i] = java.trees()[0], float(rate) if i else 1.0
    whole = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_{rounds}", kept, weights, model.numFeatures, model.numClasses
    )
    longer = model._copyValues(GBTClassificationModel(whole))._set(maxIter=rounds)
    longer._transfer_params_to_java()
    return longer


def forest_parts(candidate: Candidate) -> list[Candidate]:
    """Forests of ``PART_TREES`` trees that make up the candidate's, each with a seed of its own."""
    trees = candidate.params.get("n_estimators", 0)
    if candidate.model_type != "random_forest" or trees <= PART_TREES:
        return [candidate]
    sizes = [min(PART_TREES, trees - first) for first in range(0, trees, PART_TREES)]
    return [
        Candidate(
            candidate.run_name,
            candidate.model_type,
            {**candidate.params, "n_estimators": size, "seed": S.SEED + part},
        )
        for part, size in enumerate(sizes)
    ]


def joined_forest(parts: list) -> RandomForestClassificationModel:
    """One forest of all the parts' trees, in their order."""
    if len(parts) == 1:
        return parts[0]
    jvm, own = SparkSession.active().sparkContext._jvm, SparkSession.active().sparkContext._gateway
    trees = [tree for part in parts for tree in part._java_obj.trees()]
    kept = own.new_array(
        jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, len(trees)
    )
    for i, tree in enumerate(trees):
        kept[i] = tree
    first = parts[0]
    whole = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
        f"{first.uid}_{len(trees)}", kept, first.numFeatures, first.numClasses
    )
    joined = first._copyValues(RandomForestClassificationModel(whole))._set(numTrees=len(trees))
    joined._transfer_params_to_java()
    return joined


def loss_gradient(model, encoded: DataFrame, label: str = S.LABEL) -> DataFrame:
    """The mean weighted loss's ``gradient`` at a fitted regression, intercept last: one row.

    ``scale`` has each feature's largest absolute value, by which gradients compare.
    ``encoded`` has features, label and class weight. Sums fold inside each task, so one row
    per task travels.
    """
    p = vector_to_array("probability")[1]
    scored = model.transform(encoded).select(
        vector_to_array("features").alias("x"),
        (F.col("class_weight") * (p - F.col(label))).alias("gap"),
        "class_weight",
    )
    places = [F.get("x", F.lit(i)) for i in range(model.numFeatures)] + [F.lit(1.0)]
    weight = F.sum("class_weight")
    return scored.agg(
        F.array(*[F.sum(x * F.col("gap")) / weight for x in places]).alias("gradient"),
        F.array(*[F.max(F.abs(x)) for x in places]).alias("scale"),
    )


def feature_names(encoding: PipelineModel) -> list[str]:
    """Names of the vector's places: a level for every one-hot place, else the column."""
    levels = encoding.stages[0].labelsArray
    return [f"{c}={v}" for c, found in zip(S.CATEGORICAL, levels) for v in found] + S.NUMERIC


def tree_nodes(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Nodes of a saved forest or boosted model, one row each.

    ``tree`` and ``node``; inner nodes have ``feature``, ``threshold`` (values up to it go to
    ``low``, others to ``high``) and ``gain``, leaves have NULL there. One-hot places are two
    categories to Spark, either of which may be the left one; here they are split at one half.
    ``stats`` are the node's class weights, in boosting count, sum and sum of squares;
    ``prediction`` is its own. Spark merges leaves side by side that predict the same class.
    """
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    first = F.get("split.leftCategoriesOrThreshold", F.lit(0))
    two_way = F.col("split.numCategories") > 0
    swapped = two_way & (first == 1)
    return nodes.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.get(F.array(*[F.lit(n) for n in names]), F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.when(two_way, F.lit(0.5)).otherwise(first)).alias("threshold"),
        F.when(inner, F.col("gain")).alias("gain"),
        F.when(inner, F.when(swapped, F.col("rightChild")).otherwise(F.col("leftChild"))).alias("low"),
        F.when(inner, F.when(swapped, F.col("leftChild")).otherwise(F.col("rightChild"))).alias("high"),
        "prediction",
        F.col("impurityStats").alias("stats"),
    )


def assemble(encoding: PipelineModel, classifier) -> PipelineModel:
    """Encoding and classifier as one artifact that scores raw feature columns."""
    return PipelineModel(stages=[*encoding.stages, classifier])

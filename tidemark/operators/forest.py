"""Large random forests: every tree is grown by one task, saved by it and scored by another.

Spark ML gathers all trees of a fit on the driver, which hundreds of deep ones outgrow. Here the
driver holds the profiles of the rows and no tree. The trees are Spark ML's in their kind: rows
drawn by Poisson(1), a fresh draw of features for each node, every value of a feature a split, the
best weighted Gini gain, leaves side by side that predict the same class merged. They are saved in
Spark ML's own files, so the artifact is a ``RandomForestClassificationModel`` like any other.
"""

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.parquet as parquet
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import models, split

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package

POSITION_BITS, CUT_BITS = 21, 14  # of a sort key: a row's position and its value's number
MOST_PROFILES = 1 << POSITION_BITS  # that a task holds; with more, forests are Spark ML's
TREES_PER_TASK = 8
NODES_PER_BATCH = 1 << 16
WIDE = 64  # values from which a feature's rows may be sorted in place of counted
VOTE = 1 << 50  # a whole vote; sums of votes are whole numbers, the same in any order

NODES = (
    "treeID int, id int, prediction double, impurity double, no double, yes double, "
    "rawCount bigint, gain double, leftChild int, rightChild int, featureIndex int, threshold double"
)


def in_tasks(candidate: models.Candidate) -> bool:
    """Whether a forest is so large that its trees are grown in tasks."""
    if candidate.model_type != "random_forest" or {*candidate.params} - {"n_estimators", "max_depth"}:
        return False
    depth = models.in_force(candidate.params)["max_depth"]
    return candidate.params["n_estimators"] > models.PART_TREES or depth > models.WALKED_DEPTH


def places(encoding: PipelineModel) -> list[Column]:
    """The places of the feature vector as whole numbers."""
    levels = zip(S.CATEGORICAL, encoding.stages[0].labelsArray)
    onehot = [F.coalesce(F.col(c) == v, F.lit(False)).cast("int") for c, found in levels for v in found]
    return [*onehot, *[F.col(c).cast("int") for c in S.NUMERIC]]


def gathered(profiles: DataFrame, encoding: PipelineModel) -> dict:
    """Profiles in their order: ``x`` with a column for each place, ``label`` and ``rows``."""
    columns = [c.alias(f"_{i}") for i, c in enumerate(places(encoding))]
    table = profiles.select(*columns, F.col(S.LABEL).alias("label"), split.ROWS).toArrow()
    x = np.empty((table.num_rows, len(columns)), np.int32)
    for i in range(len(columns)):
        x[:, i] = table.column(f"_{i}").to_numpy()
    return {
        "x": x,
        "label": table.column("label").to_numpy(),
        "rows": table.column(split.ROWS).to_numpy(),
    }


def numbered(profiles: dict, weights: dict) -> dict:
    """Training profiles for ``grown``: each value's number, and where neighbours part.

    All values of a place are told apart up to ``MOST_SPLITS``; beyond that neighbours share one.
    """
    x = profiles["x"]
    bins, edges = np.empty(x.shape, np.uint16), []
    for i in range(x.shape[1]):
        values, place = np.unique(x[:, i], return_inverse=True)
        number = np.arange(len(values)) * min(models.MOST_SPLITS, len(values)) // len(values)
        bins[:, i] = number[place]
        last = np.flatnonzero(np.diff(number))
        edges.append((values[last] / 2 + values[last + 1] / 2).astype(float))
    widths = np.array([len(e) + 1 for e in edges])
    return {
        "bins": bins,
        "widths": widths,
        "edges": np.concatenate([np.append(e, np.nan) for e in edges]),
        "yes": profiles["label"] == 1,
        "rows": profiles["rows"],
        "weights": (weights.get(0) or 0.0, weights.get(1) or 0.0),
    }


def gini(no, yes):
    total = no + yes
    return 1.0 - (no * no + yes * yes) / (total * total)


def _best_of(pairs: tuple, counts: tuple, weights: tuple, best: dict) -> None:
    """Improve each node's ``best`` split by those of one feature.

    ``pairs`` are nodes and values that occur, in order, with running sums of both classes.
    """
    node, value, no, yes = pairs
    if not len(node):
        return
    last = np.append(node[1:] != node[:-1], True)
    ends = np.flatnonzero(last)
    sizes = np.diff(ends, prepend=-1)
    no, yes = (s - np.repeat(np.append(0.0, s[ends[:-1]]), sizes) for s in (no, yes))
    cut = np.flatnonzero(~last)  # above a node's largest value nothing is left
    if not len(cut):
        return
    node, value, no, yes = node[cut], value[cut], no[cut], yes[cut]
    low = no * weights[0], yes * weights[1]
    high = (counts[0][node] - no) * weights[0], (counts[1][node] - yes) * weights[1]
    a, b = low[0] + low[1], high[0] + high[1]
    gain = best["impurity"][node] - (a * gini(*low) + b * gini(*high)) / (a + b)
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    most = np.maximum.reduceat(gain, starts)
    first = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(starts, len(node)))))
    first = first[np.append(True, node[first][1:] != node[first][:-1])]
    first = first[gain[first] > best["gain"][node[first]]]
    at = node[first]
    best["gain"][at], best["cut"][at] = gain[first], value[first]
    best["no"][at], best["yes"][at] = no[first], yes[first]
    best["feature"][at] = best["picked"][at]


def best_splits(table: dict, rows: tuple, counts: tuple, picks: np.ndarray) -> dict:
    """For each node the best split of its picked features: gain, feature, cut, counts below.

    ``rows`` are profiles, their drawn counts by class and their nodes. Values of a narrow feature
    are counted, rows of a wide one are sorted where it has more values than they can fill.
    """
    at, no, yes, node = rows
    size, (width, weights) = len(counts[0]), (table["widths"], table["weights"])
    best = {name: np.zeros(size) for name in ("gain", "no", "yes")}
    best |= {"feature": np.full(size, -1), "cut": np.zeros(size, np.int64)}
    best["impurity"] = gini(counts[0] * weights[0], counts[1] * weights[1])
    flat, features = table["bins"].ravel(), table["bins"].shape[1]
    for picked in picks.T:
        best["picked"] = picked
        value = flat[at * features + picked[node]].astype(np.int64)
        wide = width[picked] > WIDE
        if width[picked].sum() <= 4 * len(at):
            wide[:] = False
        room = np.where(wide, 0, width[picked])
        start = np.cumsum(room) - room
        some = np.flatnonzero(~wide[node]) if wide.any() else slice(None)
        cell = start[node[some]] + value[some]
        cells = int(room.sum())
        sums = [np.bincount(cell, c[some], cells) for c in (no, yes)]
        filled = np.flatnonzero(sums[0] + sums[1])
        owner = np.repeat(np.arange(size), room)[filled]
        running = [np.cumsum(s[filled]) for s in sums]
        _best_of((owner, filled - start[owner], *running), counts, weights, best)
        if wide.any():
            some = np.flatnonzero(wide[node])
            key = (node[some] << CUT_BITS | value[some]) << POSITION_BITS | some
            key.sort()
            place, pair = key & (MOST_PROFILES - 1), key >> POSITION_BITS
            ends = np.flatnonzero(np.append(pair[1:] != pair[:-1], True))
            running = [np.cumsum(c[place])[ends] for c in (no, yes)]
            pair = pair[ends]
            found = (pair >> CUT_BITS, pair & ((1 << CUT_BITS) - 1), *running)
            _best_of(found, counts, weights, best)
    return best


def grown(table: dict, seed: int, tree: int, depth: int) -> dict:
    """One tree's nodes in arrays, level by level, the root first and children side by side."""
    rng = np.random.default_rng([seed, tree])
    drawn = rng.poisson(table["rows"])
    while not drawn.any():
        drawn = rng.poisson(table["rows"])
    at = np.flatnonzero(drawn)
    drawn, is_yes = drawn[at].astype(float), table["yes"][at]
    rows = (at, np.where(is_yes, 0.0, drawn), np.where(is_yes, drawn, 0.0), np.zeros(len(at), np.int64))
    counts = tuple(np.array([rows[i].sum()]) for i in (1, 2))
    features = len(table["widths"])
    subset = math.ceil(math.sqrt(features))
    levels, ahead = [], 0
    for level in range(depth + 1):
        size = len(counts[0])
        nodes = {"no": counts[0], "yes": counts[1], "gain": np.full(size, -1.0)}
        nodes |= {name: np.full(size, -1) for name in ("feature", "cut", "left")}
        levels.append(nodes)
        mixed = np.flatnonzero((counts[0] > 0) & (counts[1] > 0))
        if level == depth or not len(mixed):
            break
        order = rng.random((len(mixed), features)).argpartition(subset - 1, axis=1)
        best = best_splits(table, rows, tuple(c[mixed] for c in counts), order[:, :subset])
        parted = best["gain"] > 0
        inner = mixed[parted]
        if not len(inner):
            break
        for name in ("gain", "feature", "cut"):
            nodes[name][inner] = best[name][parted]
        nodes["left"][inner] = ahead + size + 2 * np.arange(len(inner))
        ahead += size
        below = [best[name][parted] for name in ("no", "yes")]
        counts = tuple(
            np.stack([low, c[inner] - low], axis=1).ravel() for low, c in zip(below, counts)
        )
        inside = np.flatnonzero(parted[rows[3]])
        at, no, yes, node = (r[inside] for r in rows)
        value = table["bins"].ravel()[at * features + best["feature"][node]]
        child = 2 * (np.cumsum(parted) - 1)[node] + (value > best["cut"][node])
        mixed = (counts[0] > 0) & (counts[1] > 0)
        inside = np.flatnonzero(mixed[child])
        node = (np.cumsum(mixed) - 1)[child[inside]]
        rows = (at[inside], no[inside], yes[inside], node)
    return _merged(levels, table)


def _merged(levels: list[dict], table: dict) -> dict:
    nodes = joined(levels)
    no, yes = (nodes[name] * w for name, w in zip(("no", "yes"), table["weights"]))
    nodes |= {"no": no, "yes": yes, "rawCount": nodes["no"] + nodes["yes"]}
    nodes |= {"impurity": gini(no, yes), "prediction": (yes > no).astype(float)}
    return as_saved(nodes, levels, table)


def joined(levels: list[dict]) -> dict:
    return {name: np.concatenate([level[name] for level in levels]) for name in levels[0]}


def as_saved(nodes: dict, levels: list[dict], table: dict) -> dict:
    """The tree without leaves side by side that predict the same, as Spark ML saves it."""
    ends = np.cumsum([len(level["left"]) for level in levels])
    ranges = list(zip(np.append(0, ends[:-1]), ends))
    predicted, leaf, left = nodes["prediction"], nodes["feature"] < 0, nodes["left"]
    for low, high in reversed(ranges):
        inner = low + np.flatnonzero(~leaf[low:high])
        one = left[inner]
        alike = leaf[one] & leaf[one + 1] & (predicted[one] == predicted[one + 1])
        leaf[inner[alike]] = True
    kept = np.zeros(len(leaf), bool)
    kept[0] = True
    for low, high in ranges:
        one = left[low + np.flatnonzero(kept[low:high] & ~leaf[low:high])]
        kept[one] = kept[one + 1] = True
    number = np.cumsum(kept) - 1
    nodes = {name: values[kept] for name, values in nodes.items()}
    leaf = leaf[kept]
    feature, cut, left = (nodes.pop(name) for name in ("feature", "cut", "left"))
    below = np.where(leaf, -1, number[left])
    edge = (np.cumsum(table["widths"]) - table["widths"])[feature] + cut
    return nodes | {
        "id": np.arange(len(leaf)),
        "gain": np.where(leaf, -1.0, nodes["gain"]),
        "leftChild": below,
        "rightChild": np.where(leaf, -1, below + 1),
        "featureIndex": np.where(leaf, -1, feature),
        "threshold": np.where(leaf, 0.0, table["edges"][np.where(leaf, 0, edge)]),
    }


def arrow(columns: dict, kinds: str) -> pa.RecordBatch:
    types = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    schema = pa.schema([(n, types[kind]) for n, kind in (c.split() for c in kinds.split(", "))])
    arrays = [pa.array(columns[f.name].astype(f.type.to_pandas_dtype()), f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def batches_of(nodes: dict, kinds: str):
    size = len(next(iter(nodes.values())))
    for first in range(0, size, NODES_PER_BATCH):
        yield arrow({k: v[first : first + NODES_PER_BATCH] for k, v in nodes.items()}, kinds)


def tree_rows(spark: SparkSession, table, candidate: models.Candidate) -> DataFrame:
    """The nodes of the candidate's trees as Spark ML saves them, whole trees in each partition.

    ``table`` is a broadcast of ``numbered`` profiles. A tree depends on them, the seed and its
    own number alone.
    """
    trees = candidate.params["n_estimators"]
    depth = models.in_force(candidate.params)["max_depth"]

    def run(batches):
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                nodes = grown(table.value, S.SEED, tree, depth)
                nodes["treeID"] = np.full(len(nodes["id"]), tree)
                yield from batches_of(nodes, NODES)

    rows = spark.range(0, trees, 1, -(-trees // TREES_PER_TASK)).mapInArrow(run, NODES)
    return node_rows(rows, "no", "yes")


def node_rows(rows: DataFrame, *stats: str) -> DataFrame:
    """Flat nodes in the columns of Spark ML's files."""
    inner = F.col("featureIndex") >= 0
    part = F.struct(
        "featureIndex",
        F.when(inner, F.array("threshold"))
        .otherwise(F.array().cast("array<double>"))
        .alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    plain = ["rawCount", "gain", "leftChild", "rightChild"]
    sums = F.array(*stats).alias("impurityStats")
    node = F.struct("id", "prediction", "impurity", sums, *plain, part.alias("split"))
    return rows.select("treeID", node.alias("nodeData"))


def stump(candidate: models.Candidate, rows: int, splits: int, features: int):
    """A forest of the candidate's settings and number of trees, each a mere split of two rows:
    what of a saved forest is beside its nodes."""
    return models.joined_forest([of_two_rows(candidate, rows, splits, features)] * candidate.params["n_estimators"])


def of_two_rows(candidate: models.Candidate, rows: int, splits: int, features: int):
    """One tree of the candidate's settings."""
    two = [(Vectors.dense([float(y)] * features), y, 1.0) for y in (0, 1)]
    columns = ["features", S.LABEL, "class_weight"]
    return models.estimator(
        candidate.model_type, {**candidate.params, "n_estimators": 1}, rows, splits=splits
    ).fit(SparkSession.active().createDataFrame(two, columns).coalesce(1))


def nodes_path(uri: str, model: PipelineModel) -> str:
    """Where Spark ML keeps the nodes of a saved pipeline's last stage."""
    last = len(model.stages) - 1
    digits = len(str(len(model.stages)))
    return f"{uri}/stages/{last:0{digits}d}_{model.stages[-1].uid}/data"


def walked(nodes: dict, x: np.ndarray) -> np.ndarray:
    """The leaf of each row of ``x`` in a tree."""
    at = np.zeros(len(x), np.int64)
    live = np.arange(len(x))
    while len(live):
        feature = nodes["featureIndex"][at[live]]
        inner = feature >= 0
        live, feature = live[inner], feature[inner]
        node = at[live]
        high = x[live, feature] > nodes["threshold"][node]
        at[live] = np.where(high, nodes["rightChild"][node], nodes["leftChild"][node])
    return at


def _file_nodes(content: bytes) -> dict:
    """The nodes of a saved file in arrays, by tree and id."""
    table = parquet.read_table(pa.BufferReader(content)).combine_chunks()
    node = table.column("nodeData").combine_chunks()
    part = node.field("split")
    nodes = {name: node.field(name).to_numpy() for name in ("id", "leftChild", "rightChild")}
    nodes["treeID"] = table.column("treeID").to_numpy()
    nodes["featureIndex"] = part.field("featureIndex").to_numpy()
    nodes["threshold"] = np.zeros(len(nodes["id"]))
    edges = part.field("leftCategoriesOrThreshold").flatten().to_numpy()
    nodes["threshold"][nodes["featureIndex"] >= 0] = edges
    no, yes = node.field("impurityStats").flatten().to_numpy().reshape(-1, 2).T
    nodes["vote"] = np.rint(yes / (no + yes) * VOTE).astype(np.int64)
    order = np.lexsort((nodes["id"], nodes["treeID"]))
    return {name: values[order] for name, values in nodes.items()}


def scores(spark: SparkSession, path: str, profiles, seq: int, trees: int) -> DataFrame:
    """Mean vote of the saved trees for each of the test profiles, a broadcast of ``gathered``.

    A file holds whole trees and one task reads it; votes are summed as whole numbers, so their
    sums are the same in any order.
    """
    schema = "profile bigint, label int, rows bigint, votes bigint"

    def run(batches):
        held, votes = profiles.value, 0
        for batch in batches:
            for content in batch.column(0):
                nodes = _file_nodes(content.as_buffer())
                starts = np.flatnonzero(nodes["id"] == 0)
                for first, end in zip(starts, np.append(starts[1:], len(nodes["id"]))):
                    tree = {name: values[first:end] for name, values in nodes.items()}
                    votes = votes + tree["vote"][walked(tree, held["x"])]
        if np.ndim(votes):
            found = {"profile": np.arange(len(votes)), "votes": votes}
            yield from batches_of(found | {"label": held["label"], "rows": held["rows"]}, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return (
        files.select("content")
        .mapInArrow(run, schema)
        .groupBy("profile", "label", "rows")
        .agg((F.sum("votes") / F.lit(float(VOTE)) / trees).alias("p"))
        .select(F.lit(seq).alias("seq"), "label", "p", F.col("rows").alias(split.ROWS))
    )

import hashlib
import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import split

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def by_ranking(rows, fraction, seed):
    """The same split by sorting each class, in plain Python."""
    sizes = split.test_sizes(Counter(r[-1] for r in rows), fraction)
    result = Counter()
    for label, n_test in sizes.items():

        def digest(row):
            parts = ["\\N" if v is None else str(v) for v in row]
            return hashlib.md5("\x1f".join([*parts, str(seed)]).encode()).hexdigest()

        ordered = sorted((r for r in rows if r[-1] == label), key=digest)
        result.update((*r, "test") for r in ordered[:n_test])
        result.update((*r, "train") for r in ordered[n_test:])
    return result


def frame(spark, rows):
    return spark.createDataFrame(rows, "a int, b string, no_show int")


@FEW
@given(
    st.lists(
        st.tuples(
            st.integers(0, 4), st.sampled_from(["x", "y", None]), st.integers(0, 1)
        ),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([0.2, 0.5]),
)
def test_equals_ranking_however_many_copies(spark, rows, fraction):
    got = split.stratified_split(frame(spark, rows), fraction=fraction)
    assert bag(got) == by_ranking(rows, fraction, 42)


@pytest.mark.parametrize("pieces", [4, 256])
def test_equals_ranking_through_several_levels(spark, monkeypatch, pieces):
    monkeypatch.setattr(split, "PIECES", pieces)
    monkeypatch.setattr(split, "LEVEL_BYTES", 1)
    rows = [(i % 700, "x", int(i % 3 == 0)) for i in range(2000)] + [(-1, "hot", 1)] * 1000
    assert bag(split.stratified_split(frame(spark, rows))) == by_ranking(rows, 0.2, 42)


def test_a_hot_row_is_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(split, "COPIES_PER_CHUNK", 7)
    rows = [(1, "hot", 0)] * 1000 + [(i, "x", 1) for i in range(500)]
    assert bag(split.stratified_split(frame(spark, rows))) == by_ranking(rows, 0.2, 42)


def test_survives_repartitioning(spark):
    df = spark.range(3000).selectExpr("id % 900 AS a", "id % 7 = 0 AS b", "cast(id % 3 = 0 AS int) AS no_show")
    first = bag(split.stratified_split(df))
    assert first == bag(split.stratified_split(df.repartition(13)))
    assert first == bag(split.stratified_split(df.orderBy(F.desc("a")).coalesce(1)))
    assert first != bag(split.stratified_split(df, seed=7))


def test_sizes_add_up_exactly():
    for total, positive in [(10, 3), (11, 5), (35, 1), (101, 50), (27238, 9000), (7, 7)]:
        counts = {0: total - positive, 1: positive}
        counts = {c: n for c, n in counts.items() if n}
        sizes = split.test_sizes(counts, 0.2)
        assert sum(sizes.values()) == math.ceil(0.2 * total)
        assert all(abs(sizes[c] - 0.2 * counts[c]) <= 1 for c in counts)


def test_refuses_a_label_with_many_values(spark):
    df = spark.range(500).select(F.col("id").alias("no_show"))
    with pytest.raises(ValueError, match="no_show has values"):
        split.stratified_split(df)


def test_weights_balance_the_classes(spark):
    df = frame(spark, [(i, "x", int(i < 20)) for i in range(100)])
    rows = {r["no_show"]: r for r in split.class_weights(df).collect()}
    assert rows[0]["class_weight"] == 100 / (2 * 80) and rows[1]["class_weight"] == 100 / (2 * 20)
    weights = {c: r["class_weight"] for c, r in rows.items()}
    weighted = split.with_class_weight(df, weights)
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(100)
    assert "Join" not in weighted._jdf.queryExecution().executedPlan().toString()


def test_a_single_class_has_weight_one(spark):
    assert split.class_weights(frame(spark, [(1, "x", 0)] * 5)).first()["class_weight"] == 1.0


def test_an_empty_table_splits_to_nothing(spark):
    assert split.stratified_split(frame(spark, [])).count() == 0

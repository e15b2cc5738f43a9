"""The mix of sources against plain sums."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm.corpus import SCHEMA, awkward
from tidemark.llm import curriculum as M


def rows_of(sizes):
    """(source, size) as documents."""
    return [(i, " ".join("w" * n), "en", s, 0) for i, (s, n) in enumerate(sizes)]


def shares(sizes, weights=M.WEIGHTS, most=3):
    """Targets, reshared again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in target]
        given = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if given[s] > most * sizes[s]]
        if not above:
            return {**target, **given}
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def check(spark, rows, tolerance=1):
    out = M.mix(frame(spark, rows)).collect()
    size = defaultdict(int)
    for _, text, _, source, _ in rows:
        size[source] += len((text or "").encode().split())
    wanted, taken = shares(size), defaultdict(int)
    source_of = defaultdict(set)
    for doc_id, _, _, source, _ in rows:
        source_of[doc_id].add(source)
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        (source,) = source_of[r["doc_id"]]
        assert r["source_size"] == size[source]
        assert r["target"] == pytest.approx(wanted[source])
        taken[source] += r["taken"]
    for source in size:
        assert abs(taken[source] - wanted[source]) <= tolerance
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_targets_are_met_and_no_document_is_read_too_often(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "é", "Z", "", "z\U0001f600", "z￿", None][: rng.randint(1, 8)]
    scale = {s: rng.choice([1, 10, 200]) for s in names}
    sizes = [(s, rng.randint(0, scale[s])) for s in rng.choices(names, k=400)]
    check(spark, rows_of(sizes))


def test_one_small_source_stops_at_three_passes(spark):
    out = check(spark, rows_of([("a", 5), ("a", 7), ("b", 1000), ("c", 1000)]))
    small = [r for r in out if r["source_size"] == 12]
    assert [r["taken"] == 3 * r["size"] for r in small] == [True, True]
    assert all(r["target"] == 36 for r in small)


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(i, t, "en", s, 0) for (i, t), s in zip(awkward(), ["a"] * 12 + ["b", "b", None])]
    df = frame(spark, rows)
    for name in ("size", "h", "n", "start", "bucket", "words", "turn", "goal", "copy", "passes"):
        df = df.withColumn(name, F.lit("x"))
    out = M.mix(df).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in rows)
    assert all(r["taken"] == 0 and r["first_position"] is None for r in out if r["size"] == 0)
    assert M.mix(frame(spark, [])).collect() == []
    nothing = M.mix(frame(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()
    assert all((r["target"], r["taken"]) == (0, 0) for r in nothing)


def test_crowds_of_equal_rows_are_dealt_like_others(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 7)
    rows = [(None, "a b c", "en", "a", 0)] * 500 + rows_of([("b", 9)] * 200 + [("c", 30)] * 40)
    out = M.mix(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    crowd = [r["taken"] for r in out if r["doc_id"] is None]
    assert abs(sum(crowd) - [r["target"] for r in out if r["doc_id"] is None][0]) <= 1
    assert sum(t % 3 != 0 for t in crowd) <= 1


def test_reruns_and_layouts_agree(spark, monkeypatch):
    rng = random.Random(9)
    rows = rows_of([(rng.choice("abc"), rng.randint(1, 50)) for _ in range(500)])
    first = sorted(map(tuple, M.mix(frame(spark, rows)).collect()))
    monkeypatch.setattr(M, "BUCKET_ROWS", 10)
    rng.shuffle(rows)
    again = sorted(map(tuple, M.mix(frame(spark, rows).repartition(13)).collect()))
    assert first == again


def test_positions_follow_the_schedules(spark):
    """At each time every source has given the part of its target that its schedule's integral
    has reached; rows come in order of position."""
    schedules = ([(0.0, 1.0), (0.25, 3.0), (1.0, 0.0)], [(0.0, 0.0), (0.5, 0.0), (1.0, 4.0)])
    rows = rows_of([("a", 20)] * 300 + [("b", 20)] * 300)
    out = M.curriculum(frame(spark, rows), schedules).collect()
    assert [r["position"] for r in out] == sorted(r["position"] for r in out)

    def area(schedule, upto):
        total = 0.0
        for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
            t = min(max(upto, t0), t1)
            total += (a + (a + (b - a) * (t - t0) / (t1 - t0))) / 2 * (t - t0)
        return total

    for source, schedule in zip("ab", schedules):
        own = [r for r in out if r["source"] == source]
        total = sum(r["words"] for r in own)
        for time in (0.1, 0.25, 0.4, 0.6, 0.9, 1.0):
            given = sum(r["words"] for r in own if r["position"] <= time)
            assert given / total == pytest.approx(area(schedule, time) / M.integral(schedule), abs=0.01)

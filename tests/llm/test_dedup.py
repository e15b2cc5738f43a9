"""Exact, near and substring de-duplication against plain versions."""

import random
import re
from hashlib import sha256

import pytest
import xxhash
from pyspark.sql import functions as F

from llm.corpus import awkward, components, prose, repeated, table
from tidemark.llm import components as graph
from tidemark.llm import exact_dedup, simhash, substring_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def exact_plain(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(SPACE.sub(" ", text or ""), []).append(doc_id)
    return groups


@pytest.mark.parametrize("slice_rows", [1000, 2])
def test_exact_dedup(spark, monkeypatch, slice_rows):
    """Also with slices so small that every group of three or more is hot."""
    monkeypatch.setattr(exact_dedup, "LEAST_SLICE", slice_rows)
    rows = awkward() + [(100 + i, "same  text") for i in range(9)] + [(90, "same\ttext")]
    groups = exact_plain(rows)
    got = exact_dedup.exact_dedup(table(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(r["text_sha256"], []).append(r)
    for text, ids in groups.items():
        own = by_text[sha256(text.encode()).hexdigest()]
        assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in own)
        least = min((i for i in ids if i is not None), default=None)
        assert {r["keep_id"] for r in own} == {least}
        assert {r["group_size"] for r in own} == {len(ids)}
        assert [r["doc_id"] for r in own if r["kept"]] == [least]


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(table(spark, [])).collect() == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("tree_rows", [4096, 2])
def test_simhash(spark, monkeypatch, tree_rows):
    """Also with trees so small that shards are cut into slices."""
    monkeypatch.setattr(simhash, "TREE_ROWS", tree_rows)
    rows = awkward()
    base = prose(5, 400).split()
    for i in range(40):  # near copies that differ in a word or two
        words = list(base)
        words[(i * 37) % 400] = "changed"
        if i % 3 == 0:
            words[(i * 11) % 400] = f"other{i}"
        rows.append((200 + i, " ".join(words)))
    prints = [plain_fingerprint(t) for _, t in rows]
    want = {}
    for group in components(prints, lambda a, b: (a ^ b).bit_count() <= 2):
        least = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
        want.update({i: least for i in group})
    expected = sorted((str(rows[i][0]), f"{prints[i]:016x}", str(want[i])) for i in range(len(rows)))
    got = simhash.simhash_groups(table(spark, rows, extra=True)).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == expected
    assert len({w for w in want.values()}) < len(set(prints))  # some did link


def test_simhash_of_nothing(spark):
    assert simhash.simhash_groups(table(spark, [])).collect() == []


def test_bk_tree_finds_what_is_near():
    rng = random.Random(3)
    values = [rng.getrandbits(16) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        near = {w for w in values if (w ^ v).bit_count() <= 2}
        assert set(tree.near(v, 2)) == near


def test_components_of_a_long_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200), (200, 201)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 201: 200}


def test_the_hub_of_a_star_needs_no_single_task(spark):
    """A star of 200,000 leaves, whose joins Spark may split, as both sides are plain shuffles."""
    size = 200_000
    df = spark.range(1, size + 1).selectExpr("0L AS a", "id AS b")
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        edges = graph.staged(df.repartition(64), "edges")
        stars = graph._large_star(edges)
        tasks = stars.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("*").alias("n"), F.max(F.xxhash64("a", "b"))
        )
        assert max(r["n"] for r in tasks.collect()) < size / 4
        got = graph.components(edges)
        assert got.count() == size and got.filter("root <> 0").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("rows", [4096, 6, 2])
def test_crowded_shards_lose_no_link(spark, monkeypatch, rows):
    """Fingerprints that agree on most blocks: finer blocks, then slices."""
    monkeypatch.setattr(simhash, "TREE_ROWS", rows)
    rng = random.Random(rows)
    bases = [rng.getrandbits(64) for _ in range(3)]
    values = {rng.getrandbits(64) for _ in range(20)}
    for _ in range(150):
        value = rng.choice(bases)
        for _ in range(rng.randint(0, 6)):
            value ^= 1 << rng.choice([3, 9, 17, 18, 19, 33, 40, 49, 60, 63])
        values.add(value)
    values = sorted(values)
    signed = [(v + (1 << 63)) % (1 << 64) - (1 << 63) for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    roots = {r["node"]: r["root"] for r in graph.components(simhash.links(distinct, 2)).collect()}
    for group in components(values, lambda a, b: (a ^ b).bit_count() <= 2):
        least = min(signed[i] for i in group)
        assert {roots.get(signed[i], signed[i]) for i in group} == {least}


@pytest.mark.parametrize("spans", [2000, 1])
def test_substring_dedup(spark, monkeypatch, spans):
    """Also where every prefix grows to a whole window."""
    monkeypatch.setattr(substring_dedup, "GROUP_SPANS", spans)
    shared = prose(50, 60)
    rows = awkward() + [
        (20, prose(21, 50) + " " + shared + " " + prose(22, 40)),
        (21, prose(23, 10) + "\n" + shared),
        (22, " ".join(shared.split()[:34])),  # a word too short
        (23, " ".join(shared.split()[:35]) + " " + prose(24, 50)),
        (24, "again " * 80),
        (25, prose(25, 50) + " " + prose(26, 40) + " " + prose(25, 50)),  # in one document
    ]
    split, kept = repeated([t for _, t in rows], substring_dedup.WINDOW)
    want = sorted(
        (str(i), len(w), len(w) - len(k), sha256(b" ".join(k)).hexdigest())
        for (i, _), w, k in zip(rows, split, kept)
    )
    got = substring_dedup.remove_repeats(table(spark, rows, extra=True)).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == want


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.remove_repeats(table(spark, [])).collect() == []
    one = substring_dedup.remove_repeats(table(spark, [(1, "a b")]), kept_text=True).first()
    assert (one["n_removed"], one["kept_text"]) == (0, "a b")

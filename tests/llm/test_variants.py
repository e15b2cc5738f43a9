"""Spelling variants against a comparison of every word with every other."""

import random
import re
import zlib
from collections import Counter

import pytest

from llm.corpus import FOLDER, awkward, table
from tidemark.llm import variants as V
from tidemark.llm.common import read
from tidemark.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def expected(rows):
    n = counted(rows)
    heads = {}  # near words begin or end alike
    for w in n:
        for key in {("a", w[:3]), ("z", w[-3:])}:
            heads.setdefault(key, []).append(w)
    found = {}
    for w in n:
        others = {v for key in (("a", w[:3]), ("z", w[-3:])) for v in heads[key] if near(w, v)}
        best = min(others, key=lambda v: (-n[v], v), default=None)
        found[w] = (len(others), best if best and n[best] >= 10 * n[w] else None)
    out = Counter()
    for w, (count, form) in found.items():
        root = w
        while found[root][1]:
            root = found[root][1]
        out[(w, form, root, n[w], count, n[form] if form else None)] += 1
    return out


def result(df):
    rows = V.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return Counter(map(tuple, rows))


def words(seed):
    """Texts of a few stems and words up to two edits from them, in skewed numbers."""
    rng = random.Random(seed)
    letters = "abABéÿÀ"
    stems = ["".join(rng.choices(letters, k=rng.randint(7, 11))) for _ in range(30)] + ["aaaaaaaa", "aaaaaaaaa"]

    def edited(w):
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w))
            kind = rng.randrange(3)
            w = w[:i] + (rng.choice(letters) if kind else "") + w[i + (kind < 2) :]
        return w

    rows = []
    for doc_id in range(60):
        chosen = [stems[int(len(stems) * rng.random() ** 4)] for _ in range(200)]
        rows.append((doc_id, rng.choice([" ", ", ", "1", "Ā", "\n"]).join(edited(w) if rng.random() < 0.3 else w for w in chosen)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_like_all_pairs(spark, seed):
    rows = words(seed)
    assert result(table(spark, rows, extra=True).repartition(5)) == expected(rows)


def test_table_like_all_pairs(spark):
    rows = [tuple(r) for r in read(spark, FOLDER).select("doc_id", "text").collect()]
    out = QUERIES["op13_spelling_variants"](spark, FOLDER)
    assert Counter(map(tuple, out.select("word", "form", "root", "n", "n_near", "form_n").collect())) == expected(rows)


def test_awkward_rows(spark):
    """Nulls, blanks, long texts, a word of 50,000 letters, repeated rows."""
    rows = awkward() + [(20, "x" * 50_000), (21, "x" * 49_999 + " " + "x" * 49_999)]
    assert result(table(spark, rows)) == expected(rows)
    assert result(table(spark, [])) == Counter()
    assert result(table(spark, [(1, None), (2, "")])) == Counter()


def test_small_pieces_number_shared_nodes_alike(spark, monkeypatch):
    """Many range partitions, so that most nodes cross a border; groups cut between batches."""
    monkeypatch.setattr(V, "PAIRS", 50)
    monkeypatch.setattr(V, "HELD_WORDS", 10)
    rows = words(4)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = V.word_counts(table(spark, rows))
        numbered = V.numbered(counts.selectExpr("word", "n", "0L AS key"), "numbered").collect()
        assert result(table(spark, rows)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by_prefix, by_node = {}, {}
    for r in numbered:
        for d, node in enumerate(r["nodes"]):
            assert by_prefix.setdefault(r["word"][:d], node) == node
            assert by_node.setdefault(node, r["word"][:d]) == r["word"][:d]
    assert sorted(numbered, key=lambda r: r["place"]) == sorted(numbered, key=lambda r: r["word"])


def test_chains_longer_than_two(spark):
    """aaaaaaa <- ... each ten times as frequent as the one before."""
    chain = ["abcdefgh", "abcdefg", "abcdefgx", "abcdefyx"]
    rows = [(i * 31 + 5, " ".join([w] * (2 * 11**k))) for i, (k, w) in enumerate(enumerate(chain))]
    assert result(table(spark, rows)) == expected(rows)

"""Small document tables with every awkward case, and plain versions of the operators."""

import os
import random
import string
import zlib
from collections import Counter, defaultdict

from pyspark.sql import types as T

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def table(spark, rows, extra=False):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:  # names that an operator might want for itself
        from pyspark.sql import functions as F

        for name in ("rid", "h", "n", "kept", "slice", "fp", "ids", "body", "score", "spans", "held_out"):
            df = df.withColumn(name, F.lit("x"))
    return df


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 8))) for _ in range(words))


def awkward():
    """Nulls, blanks, one very long text and one very long word, copies, a repeated row."""
    long = prose(1, 20_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "Two Words"),
        (6, long),
        (7, "x" * 50_000),
        (8, prose(2, 120)),
        (9, prose(2, 120).upper()),
        (10, prose(2, 120).replace(" ", " \n ")),
        (11, "été ß 😀 " * 30),
        (12, prose(3, 60)),
        (12, prose(3, 60)),
        (None, prose(3, 60)),
        (None, None),
    ]


def held(doc_id, modulus, wanted):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == wanted


def components(items, linked):
    """Union of all linked pairs by comparing each with each."""
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    groups = defaultdict(list)
    for i in range(len(items)):
        groups[find(i)].append(i)
    return list(groups.values())


def repeated(texts, window):
    """For each text the words outside every window that starts at two places or more."""
    split = [(t or "").encode().split() for t in texts]
    seen = Counter()
    for words in split:
        for i in range(len(words) - window + 1):
            seen[tuple(words[i : i + window])] += 1
    kept = []
    for words in split:
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept.append([w for w, k in zip(words, keep) if k])
    return split, kept

"""Repeated passages: windows in memory-sized groups by minimiser, numbered in each group."""

from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lists, map_batches, staged, texts

WINDOW = 35  # fixed value: words of a repeat
GRAM = 8  # words of the shortest prefix; every window holds WINDOW - GRAM + 1 of them
GRAMS = WINDOW - GRAM + 1
GROUP_SPANS = 2000  # spans of one prefix that a tree takes; beyond it prefixes are longer
TREE_WORDS = 1 << 20  # words whose suffixes are ranked at once
MOST_WORDS = 1_000_000  # words whose hashes a worker remembers


class WordHashes(dict):
    def __missing__(self, word):
        if len(self) > MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def anchors(batch: list[list[bytes]]):
    """For each document, runs of windows that share an anchor.

    A window's anchor is the prefix of ``GRAM`` words with the least hash among those inside
    it (the leftmost of equals), so equal windows have their anchor at the same place, and
    neighbouring windows mostly share theirs. Gives the number of runs in each document, and
    for each run its first window, its windows, the words left of the anchor in the first
    window, and the anchor's hash.
    """
    sizes = np.array([len(w) for w in batch], np.int64)
    known = _HASHES
    h = np.array([known[w] for words in batch for w in words], np.uint64)
    none = np.zeros(0, np.int64)
    if len(h) < WINDOW:
        return np.zeros(len(batch), np.int64), none, none, none, none
    with np.errstate(over="ignore"):
        g = np.zeros(len(h) - GRAM + 1, np.uint64)
        for i in range(GRAM):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(g)]
            g ^= g >> np.uint64(32)
        g *= np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(31)
    least, where = g, np.arange(len(g))
    step = 1
    while step * 2 <= GRAMS:
        least, where = _least(least, where, step)
        step *= 2
    if step < GRAMS:
        least, where = _least(least, where, GRAMS - step)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(batch)), sizes)[: len(where)]
    window = np.arange(len(where))
    inside = np.flatnonzero(window + WINDOW <= ends[owner])
    if not len(inside):
        return np.zeros(len(batch), np.int64), none, none, none, none
    where, owner = where[inside], owner[inside]
    new = np.concatenate(([True], (where[1:] != where[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate((first, [len(where)])))
    begins = (ends - sizes)[owner[first]]
    return (
        np.bincount(owner[first], minlength=len(batch)),
        inside[first] - begins,
        n,
        where[first] - inside[first],
        g[where[first]].view(np.int64),
    )


def _least(value, where, step):
    left, right = value[:-step], value[step:]
    keep = left <= right
    return np.where(keep, left, right), np.where(keep, where[:-step], where[step:])


def sketched(docs: DataFrame) -> DataFrame:
    """Rows with a key of their own, the compressed text and the anchored runs."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=6)
        for batch in batches:
            body = batch.column(2).to_pylist()
            runs, at, n, left, g = anchors([split(t) for t in body])
            yield {
                "rid": batch.column(0),
                "doc_id": batch.column(1),
                "body": [pack.compress(t.encode("utf-8", "surrogatepass")) for t in body],
                "at": lists(at.astype(np.int32), runs),
                "shape": lists((n * 64 + left).astype(np.int32), runs),
                "g": lists(g, runs),
            }

    rows = texts(docs).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    schema = "rid bigint, doc_id bigint, body binary, at array<int>, shape array<int>, g array<bigint>"
    return staged(map_batches(rows, run, schema), "sketch")


def unpacked(bodies: list[bytes]) -> list[list[bytes]]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(b).split() for b in bodies]


def spans(rows: DataFrame) -> DataFrame:
    """The words of each run whose anchor occurs more than once.

    ``span`` is given where a task meets it first; ``key`` is its digest.
    """
    runs = rows.select("rid", F.explode(F.arrays_zip("at", "shape", "g")).alias("run")).select(
        "rid", "run.*"
    )
    # Written, so that both sides of the join are plain shuffles and a hot anchor is split.
    repeated = runs.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g")
    repeated = staged(repeated, "repeated")
    wanted = (
        runs.join(repeated, "g", "left_semi")
        .groupBy("rid")
        .agg(F.collect_list(F.struct("at", "shape", "g")).alias("runs"))
        .select("rid", *[F.col("runs")[c].alias(c) for c in ("at", "shape", "g")])
    )

    def run(batches):
        seen = set()
        for batch in batches:
            rid, body, at, shape, g = (c.to_pylist() for c in batch.columns)
            out = []
            for r, words, ats, shapes, gs in zip(rid, unpacked(body), at, shape, g):
                for first, form, gram in zip(ats, shapes, gs):
                    n = form >> 6
                    span = b" ".join(words[first : first + n + WINDOW - 1])
                    key = blake2b(b"%d %d " % (form, gram) + span, digest_size=16).digest()
                    new = key not in seen
                    if new and len(seen) < MOST_WORDS:
                        seen.add(key)
                    out.append((r, first, n, gram, key, span if new else None))
            names = ["rid", "at", "n", "g", "key", "span"]
            yield dict(zip(names, map(list, zip(*out)))) if out else {c: [] for c in names}

    joined = rows.select("rid", "body").join(wanted, "rid")
    schema = "rid bigint, at int, n int, g bigint, key binary, span binary"
    return staged(map_batches(joined, run, schema), "spans")


def depth_nodes(words: np.ndarray) -> np.ndarray:
    """A number of the first ``WINDOW`` words, by prefix doubling, for each suffix with so many words.

    Nodes at depth 1, 2, 4, ... are numbered from pairs of nodes at half that depth, and the
    last from two that overlap: suffixes share a node if and only if they share that prefix.
    """
    node, depth = words, 1
    while depth * 2 <= WINDOW:
        node = _pair(node[:-depth], node[depth:])
        depth *= 2
    return _pair(node[: len(node) - (WINDOW - depth)], node[WINDOW - depth :]) if depth < WINDOW else node


def _pair(left, right):
    return np.unique((left.astype(np.int64) << 32) | right, return_inverse=True)[1]


def repeats(distinct: list[bytes], copies: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each span a bit for each of its windows: that window occurs more than once.

    ``distinct`` holds whole groups: all spans with an anchor. Spans lie in one sequence;
    only the windows inside a span are looked at.
    """
    split_spans = [s.split(b" ") for s in distinct]
    numbers: dict[bytes, int] = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for s in split_spans for w in s], np.int64)
    node = depth_nodes(words)
    begins = np.concatenate(([0], np.cumsum([len(s) for s in split_spans])))[:-1]
    owner = np.repeat(np.arange(len(distinct)), windows)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    own = node[begins[owner] + nth]
    leaves = np.bincount(own, weights=copies[owner])
    mask = np.zeros(len(distinct), np.int64)
    np.bitwise_or.at(mask, owner, (leaves[own] > 1).astype(np.int64) << nth)
    return mask


def _grouped(folded: DataFrame) -> DataFrame:
    """Masks of the spans whose anchor has at most ``GROUP_SPANS`` spans."""

    def flush(rows):
        key, n, copies, span = zip(*rows)
        mask = repeats(list(span), np.array(copies, np.int64), np.array(n, np.int64))
        return {"key": list(key), "mask": mask}

    def run(batches):
        rows, last, size = [], None, 0
        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if g != last and size > TREE_WORDS:
                    yield flush(rows)
                    rows, size = [], 0
                last, size = g, size + row[1] + WINDOW - 1
                rows.append(row)
        if rows:
            yield flush(rows)

    placed = folded.repartition("g").sortWithinPartitions("g")
    return map_batches(
        placed.select("g", "key", "n", "copies", "span"), run, "key binary, mask bigint"
    )


def _single(folded: DataFrame) -> DataFrame:
    """Masks of the spans of crowded anchors: here a prefix is a whole window.

    Windows of one prefix are folded before and after the shuffle, so that no task sees more
    than one row for each distinct window and map task.
    """

    def run(batches):
        for batch in batches:
            key, n, copies, span = (c.to_pylist() for c in batch.columns)
            out = []
            for k, windows, c, text in zip(key, n, copies, span):
                words = text.split(b" ")
                for i in range(windows):
                    window = b" ".join(words[i : i + WINDOW])
                    out.append((k, i, c, blake2b(window, digest_size=16).digest()))
            names = ["key", "nth", "copies", "window"]
            yield dict(zip(names, map(list, zip(*out)))) if out else {c: [] for c in names}

    schema = "key binary, nth int, copies bigint, window binary"
    windows = staged(map_batches(folded.select("key", "n", "copies", "span"), run, schema), "windows")
    twice = windows.groupBy("window").agg(F.sum("copies").alias("n")).filter("n > 1")
    # Written first, so that both sides of the join are plain shuffles: Spark splits a window
    # that very many spans share.
    twice = staged(twice.select("window"), "twice")
    return (
        windows.join(twice, "window", "left_semi")
        .groupBy("key")
        .agg(F.sum(F.expr("shiftleft(1L, nth)")).alias("mask"))
    )


def marked(found: DataFrame) -> DataFrame:
    """Runs with the windows that repeat: ``rid``, ``at``, ``mask``."""
    folded = staged(
        found.groupBy("key").agg(
            F.first("g").alias("g"),
            F.first("n").alias("n"),
            F.count("*").alias("copies"),
            F.first("span", ignorenulls=True).alias("span"),
        ),
        "folded",
    )
    crowded = folded.groupBy("g").agg(F.count("*").alias("m")).filter(F.col("m") > GROUP_SPANS)
    crowded = staged(crowded.select("g"), "crowded")
    masks = _grouped(folded.join(crowded, "g", "left_anti")).unionByName(
        _single(folded.join(crowded, "g", "left_semi"))
    )
    return found.select("rid", "at", "key").join(masks.filter("mask <> 0"), "key").drop("key")


def kept_words(words: list[bytes], runs: list[tuple[int, int]]) -> list[bytes]:
    """The words outside every marked window."""
    gone = np.zeros(len(words) + 1, np.int64)
    for at, mask in runs:
        while mask:
            nth = (mask & -mask).bit_length() - 1
            gone[at + nth] += 1
            gone[at + nth + WINDOW] -= 1
            mask &= mask - 1
    covered = np.cumsum(gone[:-1]) > 0
    return [w for w, c in zip(words, covered.tolist()) if not c]


def remove_repeats(docs: DataFrame, kept_text: bool = False) -> DataFrame:
    """Per document: ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text``.

    A window of ``WINDOW`` words that starts at two places anywhere, in one document or two,
    is removed wherever it is, judged on the input. Every window belongs to the group of its
    anchor; only groups with two members or more are read again. Equal runs are folded, so
    copies of a passage cost one row a task; a tree is built for the distinct ones, and where
    an anchor has very many, the prefix that makes a group grows to a whole window.

    Null texts have no words. Rows repeated under one id are documents of their own, and
    repeat each other. An empty table gives an empty result; other columns are not read.
    """
    rows = sketched(docs)
    runs = (
        marked(spans(rows))
        .groupBy("rid")
        .agg(F.collect_list(F.struct("at", "mask")).alias("runs"))
        .select("rid", F.col("runs.at").alias("at"), F.col("runs.mask").alias("mask"))
    )

    def run(batches):
        for batch in batches:
            doc_id, body, at, mask = (c.to_pylist() for c in batch.columns)
            all_words = unpacked(body)
            kept = [
                kept_words(words, list(zip(a, m))) if a else words
                for words, a, m in zip(all_words, at, mask)
            ]
            joined = [b" ".join(words) for words in kept]
            out = {
                "doc_id": doc_id,
                "n_words": [len(words) for words in all_words],
                "n_removed": [len(a) - len(b) for a, b in zip(all_words, kept)],
                "kept_sha256": [sha256(text).hexdigest() for text in joined],
            }
            if kept_text:
                out["kept_text"] = pa.array([t.decode() for t in joined])
            yield out

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    joined = rows.select("rid", "doc_id", "body").join(runs, "rid", "left")
    return map_batches(
        joined.select("doc_id", "body", "at", "mask"),
        run,
        schema + (", kept_text string" if kept_text else ""),
    )

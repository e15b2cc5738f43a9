"""Near copies by SimHash fingerprints, found with BK-trees."""

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, map_batches, only_rows, staged, with_rows
from tidemark.llm.components import components

# --- Fixed values ---
SEED = 42
SHINGLE = 3  # words
RADIUS = 2  # differing bits
# --- End of fixed values ---

LANES = 0x0101010101010101
TREE_ROWS = 4096  # fingerprints of one tree


def _hashes(text: str, width: int) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    pairs = zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist())
    return [digest(joined[i:j], SEED) for i, j in pairs]


def fingerprints_of(batch: list[str], width: int = SHINGLE) -> np.ndarray:
    """A 64-bit fingerprint for each text: the majority of its shingles, bit by bit.

    Bits are summed in byte lanes, 255 hashes at a time, for all texts of the batch at once.
    """
    hashed = [_hashes(text, width) for text in batch]
    sizes = np.array([len(h) for h in hashed], np.int64)
    out = np.zeros(len(batch), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    h = np.concatenate([np.array(hashed[i], np.uint64) for i in full])
    chunks = -(-sizes[full] // 255)
    first_chunk = np.cumsum(chunks) - chunks
    first_row = np.cumsum(sizes[full]) - sizes[full]
    within = np.arange(chunks.sum()) - np.repeat(first_chunk, chunks)
    at = np.repeat(first_row, chunks) + within * 255
    for shift in range(8):
        lanes = np.add.reduceat((h >> np.uint64(shift)) & np.uint64(LANES), at)
        by_byte = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts = np.add.reduceat(by_byte, first_chunk, axis=0)
        set_bits = counts * 2 > sizes[full][:, None]
        for byte in range(8):
            out[full] |= set_bits[:, byte].astype(np.uint64) << np.uint64(8 * byte + shift)
    return out


def fingerprints(docs: DataFrame, width: int = SHINGLE, keys: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number; whole numbers ``keys``."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            own = {name: batch.column(name) for name in ("doc_id", *keys)}
            yield {**own, "fp": fingerprints_of(texts, width).view(np.int64)}

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    schema = ", ".join(f"{name} bigint" for name in ("doc_id", *keys, "fp"))
    return map_batches(docs.select("doc_id", *keys, text), run, schema)


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.root = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            if distance == 0:
                return
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = (value, {})
                return
            node = child

    def near(self, value: int, radius: int) -> list[int]:
        """Values at most ``radius`` away, reached along edges that can lead to them."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            distance = (own ^ value).bit_count()
            if distance <= radius:
                found.append(own)
            if children:
                for key in range(max(1, distance - radius), distance + radius + 1):
                    if key in children:
                        todo.append(children[key])
        return found


def _linked(own: list[int], other: list[int], radius: int):
    """One link from each linked value to its group's root: the links of a shard, thinned."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tree = BKTree()
    for value in own:
        for near in tree.near(value, radius):
            parent[find(value)] = find(near)
        tree.add(value)
    for value in other:
        for near in tree.near(value, radius):
            parent[find(value)] = find(near)
    for value in list(parent):
        root = find(value)
        if root != value:
            yield value, root


def _masks(positions: list[int], radius: int) -> list[int]:
    """Sets of bits, one of which any two values within ``radius`` agree on.

    The positions are cut into ``radius + 2`` blocks; two of them stay untouched.
    """
    n, parts = len(positions), radius + 2
    blocks = [positions[n * i // parts : n * (i + 1) // parts] for i in range(parts)]
    return [sum(1 << p for p in [*one, *two]) for one, two in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return (mask + (1 << 63)) % (1 << 64) - (1 << 63)


def _keyed(values: DataFrame, masks: Column, choice) -> DataFrame:
    """Each ``fp`` once for every mask, with the bits below it."""
    keys = F.transform(
        masks,
        lambda m, i: F.struct(
            choice(i).cast("int").alias("choice"), F.col("fp").bitwiseAND(m).alias("bits")
        ),
    )
    return values.select("fp", F.inline(keys))


def _sizes(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1")


def _shards(distinct: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint once per choice of blocks and pair of tree slices it takes part in.

    Where more than ``TREE_ROWS`` agree on two blocks, the other bits are cut into blocks in
    their turn, and two of those are asked for as well. Only what is crowded even then is cut
    into slices that meet in pairs.
    """
    masks = _masks(list(range(64)), radius)
    finer = [
        [m | more for more in _masks([p for p in range(64) if not m >> p & 1], radius)] for m in masks
    ]
    literal = lambda ms: F.array(*[F.lit(_signed(m)).cast("bigint") for m in ms])
    keyed = _keyed(distinct, literal(masks), lambda i: i)
    sizes = staged(_sizes(keyed), "shards")
    crowded = sizes.filter(F.col("n") > TREE_ROWS).select("choice", "bits")
    again = _keyed(
        keyed.join(crowded, ["choice", "bits"]),
        F.get(F.array(*[literal(ms) for ms in finer]), F.col("choice")),
        lambda i: len(masks) * (F.col("choice") + 1) + i,
    )
    wanted = [(keyed, sizes.filter(F.col("n") <= TREE_ROWS)), (again, staged(_sizes(again), "shards"))]
    placed = [
        rows.join(
            found.select("choice", "bits", F.ceil(F.col("n") / TREE_ROWS).cast("int").alias("slices")),
            ["choice", "bits"],
        )
        for rows, found in wanted
    ]
    sliced = placed[0].unionByName(placed[1]).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    return sliced.select("fp", "choice", "bits", "own", others).select(
        "fp",
        "choice",
        "bits",
        F.least("own", "other").alias("tree"),
        F.greatest("own", "other").alias("queries"),
        (F.col("own") > F.col("other")).cast("int").alias("asks"),
    )


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a``, ``b`` that join all distinct ``fp`` at most ``radius`` bits apart.

    Fingerprints are sharded by the bits of two of ``radius + 2`` blocks: near ones agree on
    such a pair of blocks, so each finds the other in some shard. A shard's BK-tree holds
    ``TREE_ROWS`` fingerprints at most; a larger shard is keyed by two finer blocks too, and
    what is larger still is cut into slices, each pair of which is a task's work of its own
    (one slice's tree, asked by the other). Trees travel
    with the shuffle, not by broadcast: all trees together are as large as the corpus.
    A shard gives at most one link per fingerprint, however many are near.
    """
    group = ["choice", "bits", "tree", "queries"]
    shards = _shards(distinct, radius).repartition(*group).sortWithinPartitions(*group, "asks", "fp")

    def run(batches):
        key, own, other = None, [], []
        for batch in batches:
            a, b = [], []
            for fp, *now, asks in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key:
                    for x, y in _linked(own, other, radius):
                        a.append(x)
                        b.append(y)
                    key, own, other = now, [], []
                (other if asks else own).append(fp & 0xFFFFFFFFFFFFFFFF)
            yield pairs(a, b)
        yield pairs(*map(list, zip(*_linked(own, other, radius)))) if key else pairs([], [])

    def pairs(a=(), b=()):
        signed = lambda v: np.array(v, np.uint64).view(np.int64)
        return {"a": signed(list(a)), "b": signed(list(b))}

    return map_batches(shards, run, "a bigint, b bigint")


def _labelled(marked: DataFrame, least: Column, radius: int) -> DataFrame:
    """Each distinct ``fp`` with ``least`` of its rows and the ``root`` of its component."""
    distinct = staged(marked.groupBy("fp").agg(least.alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), radius))
    return distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def simhash_groups(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per document: ``fingerprint`` (hex) and ``component_id``, the smallest id reachable.

    Null, empty and white-space texts have fingerprint zero, which links like any other; a
    text of fewer words than a shingle is one shingle. Equal fingerprints are folded before
    any search. Null ids never name a component unless all its ids are null. Repeated rows
    come out repeated; an empty table gives an empty result.
    """
    marked = staged(fingerprints(docs, width), "fingerprints")
    labelled = _labelled(marked, F.min("doc_id"), radius)
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each component: one with the id that names it."""
    keyed = with_rows(docs)
    marked = staged(fingerprints(keyed, keys=(ROW,)), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW))
    labelled = _labelled(marked, first, RADIUS)
    kept = labelled.groupBy("root").agg(F.min("least").alias("least"))
    return only_rows(keyed, kept.select(f"least.{ROW}"))

"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, edit verification."""

import uuid
from collections import defaultdict
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_batches, map_batches, read, texts

SIMILARITY = 0.8  # 1 - edits / characters of the item
STEPS = 96  # of a walk; it reads about half as many characters
WALKS = 3  # independent embeddings
READS = 0.55  # characters that a step reads, a little over one half
BANDS = 14  # samples of each embedding
SAMPLED = 9  # embedded characters in a sample
ALIKE = 0.54  # of all steps of a walk, in windows that are looked at; unrelated texts agree on less
SHORT = 12  # characters; shorter items are found by exact pieces
LONG_RUN = 32  # characters without white space that have a window at each
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
BLOCK_CHARS = 1 << 21  # characters of benchmark that one pass over the documents looks for
CHUNK = 1 << 15  # windows that are walked together
SEED = 20


def normalise(text: str) -> str:
    """Lower case, each run of white space one space."""
    return " ".join(text.lower().split())


def characters(parts: list[str]) -> np.ndarray:
    """Code points of all texts; a 0 behind every text."""
    joined = "\0".join([*(p.replace("\0", " ") for p in parts), ""])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")


def coded(raw: np.ndarray) -> np.ndarray:
    """Characters as one byte from 1 to 255 each, 0 as it is."""
    with np.errstate(over="ignore"):
        mixed = (raw * np.uint32(2654435761)) >> np.uint32(16)
    return np.where(raw == 0, 0, mixed % 255 + 1).astype(np.uint8)


class Embedding:
    """CGK walks: each step writes the character it is at and moves on if a coin says so.

    The coin belongs to the step and the character, so two texts that differ by few edits
    meet again and write the same from there on. Windows are walked side by side, and what
    they write is kept step by step, so that items of any length sample the same walks. A
    text's end repeats itself, as a coin of character 0 always says no.
    """

    def __init__(self):
        rng = np.random.default_rng(SEED)
        # A coin is the top bit of the character times an odd number of the step.
        self.coins = (rng.integers(0, 128, (WALKS, STEPS)) * 2 + 1).astype(np.uint8)
        self.written = np.empty((STEPS, CHUNK), np.uint8)
        self.moves = np.empty(CHUNK, np.uint8)

    def walk(self, codes: np.ndarray, starts: np.ndarray, walk: int, steps: int) -> np.ndarray:
        """A row for each step: what each window has written."""
        n = len(starts)
        position, moves = starts.astype(np.int64), self.moves[:n]
        for step in range(steps):
            now = self.written[step, :n]
            np.take(codes, position, out=now, mode="clip")
            np.multiply(now, self.coins[walk, step], out=moves)
            np.right_shift(moves, 7, out=moves)
            np.add(position, moves, out=position, casting="unsafe")
        return self.written[:, :n]


class Samples:
    """Bit sampling of walks of so many steps: ``BANDS`` keys of ``SAMPLED`` characters each."""

    FACTOR = np.uint32(0x9E3779B1)

    def __init__(self, steps: int):
        rng = np.random.default_rng(SEED + steps)
        self.steps = steps
        # without repeats, so that every band sees as much of the text as any other
        self.chosen = [
            [np.sort(rng.permutation(steps)[: min(SAMPLED, steps)]).tolist() for _ in range(BANDS)]
            for _ in range(WALKS)
        ]

    def keys(self, written: np.ndarray, walk: int):
        """A key of each window for each band, one after another."""
        for steps in self.chosen[walk]:
            key = written[steps[0]].astype(np.uint32)
            for step in steps[1:]:
                np.multiply(key, self.FACTOR, out=key)
                np.add(key, written[step], out=key)
            np.multiply(key, self.FACTOR, out=key)
            yield key ^ (key >> np.uint32(15))


def window_starts(raw: np.ndarray) -> np.ndarray:
    """Where windows start: at every word, and at every character of scripts without spaces and
    of long runs."""
    edge = (raw == 32) | (raw == 0)
    word = ~edge & np.concatenate(([True], edge[:-1]))
    begins, ends = np.flatnonzero(word), np.flatnonzero(edge & ~np.concatenate(([True], edge[:-1])))
    if len(raw) and raw.max() >= UNSPACED[0][0]:
        for low, high in UNSPACED:
            word |= (raw >= low) & (raw <= high)
    for k in np.flatnonzero(ends - begins > LONG_RUN):
        word[begins[k] : ends[k]] = True
    return np.flatnonzero(word)


def pieces(text: str):
    """Parts of a short item with their places: one is left whole by any edits allowed."""
    n = int(len(text) * (1 - SIMILARITY) + 1e-9) + 1
    edges = [len(text) * k // n for k in range(n + 1)]
    return [(low, text[low:high]) for low, high in zip(edges, edges[1:])]


def steps_for(length: int) -> int:
    """Steps of the walks for items of so many characters: a power of two times three."""
    steps = STEPS
    while steps > 12 and steps > 1.2 * length:
        steps //= 2
    return steps


SLOTS = 18  # bits of a key by which most windows are told to have no item


class Index:
    """Keys of the items' windows, one at every word; items of like length sample alike."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, normalise(t)) for i, t in items if t and t.strip()]
        self.embedding = Embedding()
        self.classes: list[tuple[Samples, list]] = []
        self.short = [(n, pieces(t)) for n, (_, t) in enumerate(self.items) if len(t) < SHORT]
        by_steps = defaultdict(list)
        for n, (_, text) in enumerate(self.items):
            if len(text) >= SHORT:
                by_steps[steps_for(len(text))].append(n)
        for steps, members in sorted(by_steps.items()):
            samples = Samples(steps)
            raw = characters([self.items[n][1] for n in members])
            codes = coded(raw)
            lengths = np.array([len(self.items[n][1]) for n in members])
            ends = np.cumsum(lengths + 1)
            begins = ends - lengths - 1
            starts = window_starts(raw)
            owner = np.searchsorted(ends, starts, side="right")
            offset = starts - begins[owner]
            useful = (offset == 0) | (lengths[owner] - offset >= READS * steps)
            starts, owner, offset = starts[useful], owner[useful], offset[useful]
            of_item, at = np.array(members, np.int32)[owner], offset.astype(np.int32)
            tables = []
            for walk in range(WALKS):
                parts, rows = [], []
                for part in np.split(starts, range(CHUNK, len(starts), CHUNK)):
                    written = self.embedding.walk(codes, part, walk, steps)
                    parts.append(list(samples.keys(written, walk)))
                    rows.append(written[:steps].T.copy())
                bands = []
                for band in range(BANDS):
                    keys = np.concatenate([p[band] for p in parts])
                    order = np.argsort(keys, kind="stable").astype(np.int32)
                    seen = np.zeros(1 << SLOTS, bool)
                    seen[keys >> np.uint32(32 - SLOTS)] = True
                    table, begins_at = np.unique(keys[order], return_index=True)
                    bands.append((seen, table, np.append(begins_at, len(order)), order))
                tables.append((np.concatenate(rows), bands))
            self.classes.append((samples, of_item, at, tables))

    def candidates(self, codes: np.ndarray, starts: np.ndarray):
        """Pairs (window start, item, offset in the item) that share a key and whose walks write
        the same at ``ALIKE`` of all steps: their Hamming distance stands for the edits."""
        found = set()
        longest = max((samples.steps for samples, *_ in self.classes), default=0)
        for low in range(0, len(starts) if longest else 0, CHUNK):
            part = starts[low : low + CHUNK]
            for walk in range(WALKS):
                written = self.embedding.walk(codes, part, walk, longest)
                for samples, of_item, at, tables in self.classes:
                    rows, bands = tables[walk]
                    for (seen, table, begin, order), keys in zip(bands, samples.keys(written, walk)):
                        hit = np.flatnonzero(np.take(seen, keys >> np.uint32(32 - SLOTS)))
                        asked = keys[hit]
                        place = np.minimum(np.searchsorted(table, asked), len(table) - 1)
                        same = table[place] == asked
                        if not same.any():
                            continue
                        hit, place = hit[same], place[same]
                        first, n = begin[place], begin[place + 1] - begin[place]
                        asks = np.repeat(hit, n)
                        upto = np.cumsum(n)
                        told = order[np.arange(upto[-1]) + np.repeat(first - upto + n, n)]
                        for some in range(0, len(asks), CHUNK):
                            a, b = asks[some : some + CHUNK], told[some : some + CHUNK]
                            alike = (rows[b] == written[: samples.steps, a].T).sum(axis=1)
                            good = alike >= ALIKE * samples.steps
                            found.update(
                                zip(part[a[good]].tolist(), of_item[b[good]].tolist(), at[b[good]].tolist())
                            )
        return found


def infix_distance(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance between the pattern and any part of the text, and that part's end."""
    where = text.find(pattern)
    if where >= 0:
        return 0, where + len(pattern)
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        match = masks.get(c, 0)
        diagonal = match | down
        across = (((match & up) + up) ^ up) | match
        plus = down | (full & ~(across | up))
        minus = up & across
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if score < best:
            best, end = score, j
    return best, end


def finder(index: Index):
    """A function from texts to lists of (item_id, end, distance, similarity)."""

    def find(batch: list[str]) -> list[list[tuple]]:
        normal = [normalise(t) for t in batch]
        raw = characters(normal)
        codes = coded(raw)
        lengths = np.array([len(t) for t in normal], np.int64)
        ends = np.cumsum(lengths + 1)
        begins = ends - lengths - 1
        starts = window_starts(raw)
        places = defaultdict(set)
        for item, parts in index.short:
            for doc, body in enumerate(normal):
                for offset, part in parts:
                    at = body.find(part)
                    while at >= 0:
                        places[doc, item].add(at - offset)
                        at = body.find(part, at + 1)
        for at, item, offset in index.candidates(codes, starts):
            doc = int(np.searchsorted(ends, at, side="right"))
            places[doc, item].add(at - int(begins[doc]) - offset)
        out = [[] for _ in batch]
        for (doc, item), guesses in sorted(places.items()):
            item_id, text = index.items[item]
            allowed = int(len(text) * (1 - SIMILARITY) + 1e-9)
            best, seen_to = None, -1
            for guess in sorted(guesses):
                if guess <= seen_to:
                    continue
                low = max(0, guess - 2 * allowed - 2)
                high = guess + len(text) + 4 * allowed + 2
                seen_to = guess + allowed
                distance, end = infix_distance(text, normal[doc][low:high])
                if distance <= allowed and (best is None or distance < best[0]):
                    best = (distance, low + end)
            if best:
                out[doc].append((item_id, best[1], best[0], 1 - best[0] / len(text)))
        return out

    return find


_FINDERS: dict[str, Callable] = {}


def finder_of(block) -> Callable:
    """The finder of a broadcast block, built once in a worker; only the last one is kept."""
    key, items = block.value
    if key not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[key] = finder(Index(items))
    return _FINDERS[key]


def blocks(benchmark: DataFrame):
    """The items in blocks of about ``BLOCK_CHARS``, each a broadcast of bounded size.

    An index takes some 100 bytes for each character of its block.
    """
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    n = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS)
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        found = [(r["item_id"], r["text"]) for r in rows]
        yield items.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, found))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item that it holds: ``doc_id``, ``item_id``,
    ``end`` (in the normalised text), ``distance`` and ``similarity``.

    Texts are lower-cased with single spaces. A document holds an item if the item's edit
    distance to the best part of the text leaves a similarity of ``SIMILARITY`` or more;
    candidates come from LSH over windows of the items' size, and each is verified. Null and
    empty texts and items give nothing, and so does an empty table on either side. Repeated
    rows come out repeated. The benchmark is looked for in blocks of bounded size, so it may
    grow; each block is a pass over the documents, and nothing is shuffled.
    """
    found = None
    for block in blocks(benchmark):

        def run(batches, block=block):
            find = finder_of(block)
            for batch in batches:
                hits = find(batch.column(1).to_pylist())
                ids = batch.column(0).to_pylist()
                rows = [(i, *hit) for i, own in zip(ids, hits) for hit in own]
                columns = zip(*rows) if rows else [[]] * 5
                names = ["doc_id", "item_id", "end", "distance", "similarity"]
                yield dict(zip(names, map(list, columns)))

        schema = "doc_id bigint, item_id bigint, end bigint, distance bigint, similarity double"
        part = map_batches(texts(docs), run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = "doc_id bigint, item_id bigint, end bigint, distance bigint, similarity double"
        return docs.sparkSession.createDataFrame([], schema)
    return found


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item, judged where they are read."""
    for block in blocks(read(spark, folder, "benchmark")):

        def test(block=block):
            find = finder_of(block)
            return lambda batch: [not hits for hits in find([t or "" for t in batch.column("text").to_pylist()])]

        docs = filter_batches(docs, test)
    return docs

"""Packing token sequences: documents beside their nearest unused neighbours by BM25."""

import struct
import zlib
from string import ascii_lowercase, digits, punctuation

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, noted_path, texts

# --- Fixed values ---
WINDOW = 4096  # tokens of a sequence
END = 2  # the id behind each document
K1, B = 1.2, 0.75
# --- End of fixed values ---

VOCABULARY = "word_bpe_49k.json"
SHARD_DOCS = 512  # documents of one inverted index
MOST_WORDS = 1_500_000  # words whose ids a worker remembers

PUNCTUATION = punctuation.encode()
ALPHANUMERIC = (ascii_lowercase + digits).encode()

# Byte-level vocabularies write printable bytes as themselves, others from U+0100 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_TOKENIZERS: dict[str, "WordIds"] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The installed file of that name; resolved where it is called, on executors too."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Ids of whole texts, one white-space-free word at a time: words to their packed ids.

    The vocabulary's rules never join characters across white space, so a text's ids are its
    words' ids in a row; each distinct word is encoded when it is first asked for, and
    remembered. The rules don't tell A-Z from a-z either, and always part a letter or digit
    from a run of punctuation, so a word's stem and its ending are encoded, and remembered, apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.size = self.tokenizer.get_vocab_size()
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        # Plain words need no splitting rules, if these are rules that leave them whole.
        self.direct = all(self._plain(w) == self._whole(w) for w in ("a", "word", "straße", "été"))

    @classmethod
    def at(cls, path: str) -> "WordIds":
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = cls(path)
        return _TOKENIZERS[path]

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _plain(self, word: str) -> list[int]:
        """Ids of a word of lower-case letters: one piece, whose bytes go to the merges."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTES)
        return [t.id for t in self.tokenize(word)]

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)

    def __missing__(self, word: bytes) -> bytes:
        low = word.lower()
        if self.direct and word.isalpha():  # ASCII letters alone
            ids = self._packed([t.id for t in self.tokenize(low.decode())]) if low == word else self[low]
        elif b"<|" in word:  # may hold a special token, which is matched as it is written
            ids = self._packed(self._whole(word.decode("utf-8", "replace")))
        else:
            stem = low.rstrip(PUNCTUATION)
            if low != word:
                ids = self[low]
            elif stem and stem != low and stem[-1:] in ALPHANUMERIC:
                ids = self[stem] + self[low[len(stem) :]]
            else:
                text = low.decode("utf-8", "replace")
                plain = self.direct and text.isalpha() and text == text.lower() and max(text) < "\u0250"
                ids = self._packed(self._plain(text) if plain else self._whole(text))
        self[word] = ids
        return ids

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        if len(self) > MOST_WORDS:
            self.clear()
        ids, end = self.__getitem__, np.array([END], self.kind).tobytes()
        return [
            np.frombuffer(b"".join(map(ids, t.encode("utf-8", "surrogatepass").split())) + end, self.kind)
            for t in batch
        ]


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order, and how often each occurs."""
    s = np.sort(ids, kind="stable")  # a radix sort, as vocabularies fit 16 bits
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return s[first], np.diff(np.concatenate((first, [len(s)])))


def signature(ids: np.ndarray) -> int:
    """The least hash of two neighbouring ids: near texts tend to share it."""
    pairs = (ids[:-1].astype(np.uint64) << np.uint64(32)) | ids[1:]
    with np.errstate(over="ignore"):
        mixed = pairs * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return int(mixed.min() >> np.uint64(1)) if len(mixed) else 0


def tokenised(docs: DataFrame, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents' ids with a signature, and the number of documents with each id.

    Both are written in one pass: each task adds a last row with its counts.
    """

    def run(batches):
        words = WordIds.at(vocabulary or vocabulary_path())
        total = np.zeros(words.size, np.int64)
        for batch in batches:
            encoded = words.encode(batch.column(1).to_pylist())
            for ids in encoded:
                total[counted(ids)[0]] += 1
            yield {
                "doc_id": batch.column(0),
                "n": [len(ids) for ids in encoded],
                "sig": [signature(ids) for ids in encoded],
                "ids": [ids.tobytes() for ids in encoded],
                "df": [None] * len(encoded),
            }
        yield {"doc_id": [None], "n": [None], "sig": [None], "ids": [None], "df": [total]}

    path = noted_path(docs.sparkSession, "tokens")
    schema = "doc_id bigint, n bigint, sig bigint, ids binary, df array<bigint>"
    rows = map_batches(texts(docs), run, schema)
    rows.write.option("compression", "zstd").parquet(path)
    written = docs.sparkSession.read.schema(schema).parquet(path)
    counts = (
        written.filter("df IS NOT NULL")
        .select(F.posexplode("df").alias("id", "df"))
        .filter("df > 0")
        .groupBy("id")
        .agg(F.sum("df").alias("df"))
    )
    return written.filter("n IS NOT NULL").drop("df"), counts


class Shard:
    """An inverted index over some documents: each id's postings with their BM25 weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        terms, owners, weights = [], [], []
        for n, ids in enumerate(docs):
            term, tf = counted(ids)
            terms.append(term)
            owners.append(np.full(len(term), n))
            norm = K1 * (1 - B + B * len(ids) / mean)
            weights.append(idf[term] * tf * (K1 + 1) / (tf + norm))
        self.terms = terms
        flat = np.concatenate(terms)
        order = np.argsort(flat, kind="stable")
        self.owner = np.concatenate(owners)[order]
        self.weight = np.concatenate(weights)[order]
        self.starts = np.searchsorted(flat[order], np.arange(len(idf) + 1))
        self.size = len(docs)

    def scores(self, query: int) -> np.ndarray:
        """BM25 of every document for the distinct ids of one."""
        term = self.terms[query]
        low = self.starts[term]
        n = self.starts[term.astype(np.int64) + 1] - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        return np.bincount(self.owner[at], weights=self.weight[at], minlength=self.size)


def reading_order(shard: Shard, sizes: list[int], room: int):
    """Documents in the order they are laid down: a seed, then its nearest unused ones.

    ``room`` is what the current window has left. A document that a window cuts goes on in
    the next one and is that window's seed.
    """
    unused = np.ones(shard.size, bool)
    queue: list[int] = []
    seed = None
    for _ in range(shard.size):
        if seed is None:
            nxt = int(unused.argmax())
        else:
            if not queue:
                scores = np.where(unused, shard.scores(seed), -1.0)
                queue = np.argsort(-scores, kind="stable")[: int(unused.sum())].tolist()[::-1]
            nxt = queue.pop()
        unused[nxt] = False
        yield nxt
        room -= sizes[nxt]
        if seed is None:
            seed, queue = nxt, []
        if room <= 0:  # the window is full: what it cut, or the next document, is the seed
            seed = nxt if room < 0 else None
            queue = []
            room = WINDOW - (-room) % WINDOW


class Layer:
    """Cuts the stream of documents at every ``WINDOW`` tokens."""

    def __init__(self, first_sequence: int):
        self.sequence, self.filled = first_sequence, 0
        self.open: list[list] = []  # pieces of the sequence that is not full
        self.ids: list[np.ndarray] = []

    def add(self, doc_id, ids: np.ndarray):
        start = 0
        while start < len(ids):
            n = min(len(ids) - start, WINDOW - self.filled)
            self.open.append([doc_id, start, n, len(ids)])
            self.ids.append(ids[start : start + n])
            start, self.filled = start + n, self.filled + n
            if self.filled == WINDOW:
                yield from self._close(WINDOW)

    def _close(self, size: int):
        """The first ``size`` open tokens as a sequence."""
        offset, left = 0, size
        while left:
            doc_id, start, n, whole = self.open[0]
            take = min(n, left)
            ids = self.ids[0][:take]
            yield doc_id, start, take, zlib.crc32(ids.astype("<u4").tobytes()), whole, self.sequence, offset
            if take == n:
                del self.open[0], self.ids[0]
            else:
                self.open[0] = [doc_id, start + take, n - take, whole]
                self.ids[0] = self.ids[0][take:]
            offset, left = offset + take, left - take
        self.sequence, self.filled = self.sequence + 1, self.filled - size

    def finish(self):
        """What is left, as sequences of powers of two: none of them needs padding."""
        while self.filled:
            yield from self._close(1 << (self.filled.bit_length() - 1))


PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces of documents: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    Documents are tokenised once. Range partitions of (signature, id) are as even as any
    sort's, whatever share of the documents is alike, and put near texts side by side; each
    is cut into shards of ``SHARD_DOCS`` documents with an inverted BM25 index of their own
    (id and length statistics are the whole corpus's). A window starts from a seed document
    and takes the seed's best unused neighbours until it is full. Windows run on from shard to shard; at the end of
    a partition the rest becomes sequences of powers of two, so nothing is padded at all.

    Null and empty texts are one token. Repeated rows are documents of their own. An empty
    table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows, counts = tokenised(docs, vocabulary)
    n, tokens = rows.agg(F.count("*"), F.sum("n")).first()
    df = {r["id"]: r["df"] for r in counts.collect()}  # one row per id of the vocabulary
    shared = spark.sparkContext.broadcast((n, (tokens or 0) / max(n, 1), df))
    placed = rows.repartitionByRange("sig", "doc_id").sortWithinPartitions("sig", "doc_id", "n", "ids")

    def run(batches):
        n, mean, df = shared.value
        size = max(df, default=0) + 1
        kind = WordIds.at(vocabulary or vocabulary_path()).kind
        found = np.zeros(size)
        found[list(df)] = list(df.values())
        idf = np.log(1 + (n - found + 0.5) / (found + 0.5))
        layer = Layer(TaskContext.get().partitionId() << 40)

        def lay(ids, tokens):
            shard = Shard(tokens, idf, mean)
            for k in reading_order(shard, [len(t) for t in tokens], WINDOW - layer.filled):
                yield from layer.add(ids[k], tokens[k])

        ids, tokens = [], []
        for batch in batches:
            out = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                tokens.append(np.frombuffer(raw, kind))
                if len(ids) == SHARD_DOCS:
                    out.extend(lay(ids, tokens))
                    ids, tokens = [], []
            if out:
                yield dict(zip(PIECES, map(list, zip(*out))))
        out = [*(lay(ids, tokens) if ids else ()), *layer.finish()]
        if out:
            yield dict(zip(PIECES, map(list, zip(*out))))

    return map_batches(
        placed.select("doc_id", "ids"), run, ", ".join(f"{c} bigint" for c in PIECES)
    )


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """The packed pieces of the documents."""
    return pack(docs)

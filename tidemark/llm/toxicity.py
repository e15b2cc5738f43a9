"""Toxicity by compression distance: two zstandard dictionaries, windows, a calibrated score."""

from collections import Counter
from math import log

import numpy as np
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, remainder, staged

HELD_OUT, FOLDS = 2, 4  # fixed values
THRESHOLD = 0.3  # fixed value

FIT_ROWS = {1: 1500, 0: 6000}  # labelled rows the dictionaries are trained on, chosen by hash
CALIBRATION_ROWS = {1: 1500, 0: 6000}  # others, for the thresholds
FIT_SHARE = 0.5  # of the labelled rows of a class, at most
WINDOW_BYTES = 32
COMMON_BYTES, OWN_BYTES = 6000, 1024  # of a dictionary: shared and its class's own
COMMON_WORDS = 1500
LEAST_SHARE = 0.01  # of a class's texts that hold a piece
LEAST_TEXTS = 5  # that hold a piece
LEAST_ODDS = {1: 1.5, 0: 0.3}  # log odds of a piece for its class
BEST = 4  # windows whose difference is a feature each
L2 = 1e-3


def windows(text: str) -> list[bytes]:
    """Lower-cased words in a row, at least ``WINDOW_BYTES`` long but for the last."""
    out, now, size = [], [], 0
    for word in text.lower().encode("utf-8", "surrogatepass").split():
        now.append(word)
        size += len(word) + 1
        if size >= WINDOW_BYTES:
            out.append(b" %b " % b" ".join(now))
            now, size = [], 0
    if now:
        out.append(b" %b " % b" ".join(now))
    return out


def pieces(text: str) -> set[bytes]:
    """What a dictionary may hold of a text: its words and their beginnings."""
    found = set()
    for word in set(text.lower().encode("utf-8", "surrogatepass").split()):
        if len(word) <= 40:
            found.add(b" %b " % word)
        for n in (4, 5, 6):
            if len(word) > n:
                found.add(b" " + word[:n])
    return found


def compressor(content: bytes) -> zstd.ZstdCompressor:
    parameters = zstd.ZstdCompressionParameters(
        window_log=15,
        chain_log=14,
        hash_log=14,
        search_log=4,
        min_match=5,
        strategy=zstd.STRATEGY_LAZY2,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    dictionary = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstd.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


class Distances:
    """Features of a text: how much shorter its windows get with the toxic dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)

    def __call__(self, text: str) -> np.ndarray:
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        gain = [len(ordinary(w)) - len(toxic(w)) for w in windows(text)]
        best = sorted(gain, reverse=True)[:BEST]
        n = max(len(gain), 1)
        return np.array([*best, *[0] * (BEST - len(best)), sum(gain) / BEST, sum(gain) / n, log(1 + n), 1.0])


def dictionaries(sample: DataFrame, rows: dict[int, int]) -> tuple[bytes, bytes]:
    """Toxic and ordinary content, of equal size.

    Both end with the same frequent words that are typical of neither, so most text compresses
    alike; before them stands what is typical of one class, by the log odds of a text to hold it.
    """

    def run(batches):
        counts = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(pieces(text or ""))
        both = list(counts[0].keys() | counts[1].keys())
        yield {"piece": both, "t": [counts[1][p] for p in both], "o": [counts[0][p] for p in both]}

    counted = (
        map_batches(sample.select("text", "toxic"), run, "piece binary, t bigint, o bigint")
        .groupBy("piece")
        .agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    )
    odds = F.log((F.col("t") + 0.5) / (rows[1] + 1)) - F.log((F.col("o") + 0.5) / (rows[0] + 1))
    counted = staged(counted.withColumn("odds", odds), "pieces")
    common = (
        counted.filter((F.col("odds") < LEAST_ODDS[1]) & (F.col("odds") > -LEAST_ODDS[0]))
        .orderBy(F.desc(F.col("t") + F.col("o")), "piece")
        .limit(COMMON_WORDS)
        .collect()
    )
    shared = b"".join(bytes(r["piece"]) for r in reversed(common))[-COMMON_BYTES:]
    own = []
    for label, texts, own_odds in ((1, "t", F.col("odds")), (0, "o", -F.col("odds"))):
        typical = (
            counted.filter(F.col(texts) >= max(LEAST_TEXTS, LEAST_SHARE * rows[label]))
            .filter(own_odds >= LEAST_ODDS[label])
            .orderBy(own_odds.desc(), "piece")
            .limit(OWN_BYTES)
            .collect()
        )
        chosen, size = [], 0
        for piece in (bytes(r["piece"]) for r in typical):
            if size + len(piece) <= OWN_BYTES and not any(piece in c for c in chosen):
                chosen.append(piece)
                size += len(piece)
        own.append(b"".join(reversed(chosen)).rjust(OWN_BYTES, b"\n"))
    return own[0] + shared, own[1] + shared


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic thresholds over the features, by Newton's method."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    mean[-1], scale[-1] = 0, 1
    z = (x - mean) / scale
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) / weight.sum() + L2 * w
        hessian = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z / weight.sum()
        w -= np.linalg.solve(hessian + L2 * np.eye(len(w)), gradient)
    w = w / scale
    w[-1] -= (w[:-1] * mean[:-1]).sum()
    return w


def train(docs: DataFrame, labels: DataFrame):
    """Dictionaries and weights, or the share of toxic rows if there is one class alone.

    Rows are chosen by the hash of their id among the labelled ones outside the held-out
    fold: about ``FIT_ROWS`` of each class for the dictionaries, ``CALIBRATION_ROWS`` others
    for the weights. A document with several labels counts as toxic if one says so.
    """
    known = (
        labels.filter((remainder(FOLDS) != HELD_OUT) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL")
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return float(next(iter(sizes), 0))
    draw = lambda seed: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    per_class = lambda d: F.when(F.col("toxic") == 1, d[1]).otherwise(d[0])
    chosen = known.withColumn(
        "fit", draw(6) < per_class({k: min(FIT_SHARE, FIT_ROWS[k] / n) for k, n in sizes.items()})
    ).filter(F.col("fit") | (draw(7) < per_class({k: CALIBRATION_ROWS[k] / n for k, n in sizes.items()})))
    sample = staged(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "fit"),
        "labelled",
    )
    fitted = {r["toxic"]: r["n"] for r in sample.filter("fit").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    content = dictionaries(sample.filter("fit"), {0: 0, 1: 0} | fitted)

    def run(batches):
        measure = Distances(*content)
        for batch in batches:
            x = [measure(t or "") for t in batch.column(0).to_pylist()]
            yield {"x": x, "toxic": batch.column(1)}

    rows = map_batches(
        sample.filter("NOT fit").select("text", "toxic"), run, "x array<double>, toxic int"
    ).collect()  # a bounded sample
    if len({r["toxic"] for r in rows}) < 2:
        return sizes[1] / (sizes[0] + sizes[1])
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows])
    share = {k: sizes[k] / (y == k).sum() for k in (0, 1)}
    return content, calibrate(x, y, np.where(y == 1, share[1], share[0]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``held_out``, ``score`` and ``predicted``.

    Every window of the text is compressed twice, with a dictionary of toxic and one of
    ordinary text; the differences become a probability. Null and empty texts have no window
    and get the score of no difference. With labels of one class only, every text gets that
    class's score, and 0 without labels. Repeated rows come out repeated; other columns are
    not read.
    """
    model = train(docs, labels)

    def run(batches):
        measure = None if isinstance(model, float) else Distances(*model[0])
        for batch in batches:
            texts = batch.column(2).to_pylist()
            if measure is None:
                score = np.full(len(texts), model)
            else:
                x = np.array([measure(t or "") for t in texts]).reshape(len(texts), -1)
                score = 1 / (1 + np.exp(-np.clip(x @ model[1], -30, 30))) if len(texts) else np.zeros(0)
            yield {
                "doc_id": batch.column(0),
                "held_out": batch.column(1),
                "score": score,
                "predicted": (score >= THRESHOLD).astype(np.int32),
            }

    rows = docs.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "text")
    return map_batches(rows, run, "doc_id bigint, held_out boolean, score double, predicted int")

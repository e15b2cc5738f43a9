"""Language identification: sparse multinomial regression over character n-grams."""

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_batches, map_batches, remainder, staged

UNKNOWN = "und"  # fixed value: no letters to judge by
HELD_OUT, FOLDS = 2, 4

BUCKETS = 1 << 16  # hashed n-grams
FIT_ROWS = 2000  # rows of each language to fit on, chosen by hash
FIT_SHARE = 0.8  # and at most this share of them
CALIBRATION_ROWS = 500  # rows of each language, others than those, for the temperature
SHARDS = 4  # learners whose weights are averaged
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
REJECT_BELOW = 0.4


@cache
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(1 << 16)), bool, 1 << 16)


class Grams:
    """Hashed counts of 1- to 3-grams over letters; runs of anything else are one space."""

    def __init__(self):
        self.letter = _letters()

    def codes(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        known = self.letter[np.minimum(raw, 0xFFFF)]
        if len(raw) and raw.max() > 0xFFFF:
            for c in np.unique(raw[raw > 0xFFFF]).tolist():
                known = np.where(raw == c, chr(c).isalpha(), known)
        before = np.concatenate(([False], known[:-1]))
        kept = known | before
        return np.where(known, raw, 32)[kept].astype(np.uint32)

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Buckets and how often each occurs; None without a letter."""
        codes = self.codes(text)
        if not len(codes):
            return None
        codes = np.concatenate((np.array([32], np.uint32), codes))
        total = np.zeros(BUCKETS, np.int64)
        with np.errstate(over="ignore"):
            mixed = codes * np.uint32(2654435761)
            for n in (1, 2, 3):
                if n > 1:
                    mixed = (mixed[:-1] ^ (codes[n - 1 :] + np.uint32(n))) * np.uint32(2246822519)
                    mixed ^= mixed >> np.uint32(15)
                total += np.bincount(mixed >> np.uint32(16), minlength=BUCKETS)
        at = np.flatnonzero(total)
        return at, total[at]


def features(grams: Grams, idf: np.ndarray, text: str):
    """Buckets and unit-length TF-IDF values; None without a letter."""
    counted = grams.counts(text)
    if counted is None:
        return None
    at, n = counted
    x = n * idf[at]
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows, classes: int) -> np.ndarray:
    """Follow-the-regularised-leader over ``(buckets, values, class)``, elastic-net weights."""
    z = np.zeros((BUCKETS, classes))
    n = np.zeros((BUCKETS, classes))

    def weights(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for at, x, label in rows:
        w = weights(z[at], n[at])
        error = softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error[None, :]
        grown = n[at] + g * g
        z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
        n[at] = grown
    return weights(z, n)


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket by class
    temperature: float = 1.0


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts have each bucket, over all rows; and how many have any."""

    def run(batches):
        grams, total, seen = Grams(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counted = grams.counts(text)
                if counted:
                    total[counted[0]] += 1
                    seen += 1
        yield {"df": [total], "seen": [seen]}

    parts = staged(map_batches(rows.select("text"), run, "df array<bigint>, seen bigint"), "df")
    summed = (
        parts.select(F.posexplode("df").alias("bucket", "n"))
        .filter("n > 0")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # one row per bucket at most
    )
    total = np.zeros(BUCKETS)
    for bucket, n in summed:
        total[bucket] = n
    return total, parts.agg(F.sum("seen")).first()[0] or 0


def _draw(seed: int) -> Column:
    """A number from 0 to 1 that the id decides."""
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)


def train(docs: DataFrame) -> Model | None:
    """A model from rows outside the held-out fold that have a language and a text.

    Document frequencies come from all of those rows. The classifier is fitted on about
    ``FIT_ROWS`` rows of each language, chosen by the hash of their id, and the temperature
    on ``CALIBRATION_ROWS`` others. Shards of the sample are learnt apart and averaged.
    """
    known = docs.filter((remainder(FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    known = known.select("doc_id", "lang", "text").filter("text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    classes = sorted(sizes)
    df, seen = document_frequencies(known)
    idf = np.log((1 + seen) / (1 + df)) + 1
    label, rows = F.lit(-1), F.lit(1)
    for k, c in enumerate(classes):
        label = F.when(F.col("lang") == c, k).otherwise(label)
        rows = F.when(F.col("lang") == c, sizes[c]).otherwise(rows)
    to_fit = _draw(1) < F.least(F.lit(FIT_SHARE), FIT_ROWS / rows)
    sample = staged(
        known.withColumns({"label": label, "fit": to_fit})
        .filter(F.col("fit") | (_draw(2) < CALIBRATION_ROWS / rows))
        .select("doc_id", "text", "label", "fit"),
        "labelled",
    )
    weights = _fit(sample.filter("fit"), idf, len(classes))
    model = Model(classes, idf, weights)
    model.temperature = _temperature(sample.filter("NOT fit"), model)
    return model


def _fit(sample: DataFrame, idf: np.ndarray, classes: int) -> np.ndarray:
    shared = sample.sparkSession.sparkContext.broadcast(idf)

    def learn(frame):
        import pandas as pd

        grams = Grams()
        frame = frame.sort_values(["order", "doc_id"])
        rows = ((features(grams, shared.value, t), k) for t, k in zip(frame["text"], frame["label"]))
        w = ftrl(((f[0], f[1], k) for f, k in rows if f), classes)
        at, k = np.nonzero(w)
        return pd.DataFrame({"bucket": at, "class": k, "w": w[at, k] / SHARDS})

    learnt = (
        sample.withColumn("order", F.xxhash64("doc_id", F.lit(1)))
        .groupBy(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(SHARDS)))
        .applyInPandas(learn, "bucket int, class int, w double")
        .groupBy("bucket", "class")
        .agg(F.sum("w").alias("w"))
        .collect()  # buckets times classes at most
    )
    w = np.zeros((BUCKETS, classes))
    for bucket, k, value in learnt:
        w[bucket, k] = value
    return w


def _temperature(sample: DataFrame, model: Model) -> float:
    """The temperature of least log loss on the calibration rows."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = scorer(shared.value)
        for batch in batches:
            z = [score(t) for t in batch.column(1).to_pylist()]
            yield {"label": batch.column(0), "z": pa.array(z, pa.list_(pa.float64()))}

    rows = map_batches(sample.select("label", "text"), run, "label int, z array<double>")
    rows = rows.filter("z IS NOT NULL").collect()  # a bounded sample
    if not rows:
        return 1.0
    z = np.array([r["z"] for r in rows])
    y = np.array([r["label"] for r in rows])

    def loss(t):
        return -np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()

    grid = np.exp(np.linspace(np.log(0.25), np.log(10), 60))
    return float(grid[np.argmin([loss(t) for t in grid])])


def scorer(model: Model):
    """A function from a text to its class scores; None without a letter."""
    grams = Grams()

    def score(text):
        f = features(grams, model.idf, text) if text else None
        return f[1] @ model.weights[f[0]] if f else None

    return score


def predictor(model: Model | None):
    """A function from a text to its language and the calibrated probability of it."""
    if model is None:
        return lambda text: (UNKNOWN, 0.0)
    score = scorer(model)

    def predict(text):
        z = score(text)
        if z is None:
            return UNKNOWN, 0.0
        p = softmax(z / model.temperature)
        return model.classes[int(p.argmax())], float(p.max())

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """Per document: ``held_out``, ``lang_pred`` and a calibrated ``score``.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything if
    no row has a language to learn from. Ties go to the first language in order. Repeated
    rows come out repeated; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches):
        predict = predictor(shared.value)
        for batch in batches:
            found = [predict(t) for t in batch.column(2).to_pylist()]
            yield {
                "doc_id": batch.column(0),
                "held_out": batch.column(1),
                "lang_pred": [lang for lang, _ in found],
                "score": [p for _, p in found],
            }

    rows = docs.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "text")
    return map_batches(
        rows, run, "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that is recognised with at least ``REJECT_BELOW``.

    The text is judged where it is read, and whole rows pass: nothing is shuffled.
    """
    shared = spark.sparkContext.broadcast(train(docs))

    def test():
        predict = predictor(shared.value)

        def known(batch):
            found = [predict(t) for t in batch.column("text").to_pylist()]
            return [lang != UNKNOWN and p >= REJECT_BELOW for lang, p in found]

        return known

    return filter_batches(docs, test)

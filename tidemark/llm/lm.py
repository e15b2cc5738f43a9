"""Language-model scores: a gated recurrent network with a class-factored softmax."""

from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lists, map_batches, remainder, staged, texts

HELD_OUT, FOLDS = 0, 10  # fixed values
SMOOTHING = 0.1  # fixed value

CLASSES, PER_CLASS = 32, 32
MODEL_WORDS = CLASSES * PER_CLASS  # outputs: other words, the end, and the most frequent words
OTHER, END = 0, 1
FREQUENT = 100_000  # words whose counts every task has; the others' are joined
HIDDEN = 32
TRUNCATE = 32  # steps of backpropagation
FEW = 8  # rows of a word that are added place by place
BATCH = 256  # documents learnt side by side
ROUNDS = 3  # each starts from the average of the last one's learners
RATE = 0.01
LANES = 1024  # documents scored side by side
STEPS = 64  # of a scoring window
TASK_TOKENS = 6_000_000  # tokens a task holds before it scores them
VECTORS = 32  # of parameters that are added up at once
TASK_WORDS = 300_000  # words a task counts before it passes them on


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many each text has."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes, words = words.value_lengths().to_numpy(zero_copy_only=False), words.flatten()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # space at a text's ends leaves empty ones
    if not real.all():
        edges = np.concatenate(([0], np.cumsum(real)))[np.concatenate(([0], np.cumsum(sizes)))]
        sizes, words = np.diff(edges), words.filter(pa.array(real))
    return words.cast(pa.binary()), sizes


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word occurs in all the documents given."""

    def folded(tables):
        table = pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return table.select(["word", "c_sum"]).rename_columns(["word", "c"]).combine_chunks()

    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            counted = split(batch.column(0))[0].value_counts()
            waiting.append(pa.table({"word": counted.field(0), "c": counted.field(1)}))
            size += len(counted)
            if size > 2 * TASK_WORDS:
                waiting = [folded(waiting)]
                size = len(waiting[0])
                if size > TASK_WORDS:
                    yield from passed(waiting[0])
                    waiting, size = [], 0
        if waiting:
            yield from passed(folded(waiting))

    def passed(table):
        for batch in table.to_batches():
            yield {"word": batch["word"], "c": batch["c"]}

    counted = map_batches(docs.select("text"), run, "word binary, c bigint")
    return staged(counted.groupBy("word").agg(F.sum("c").alias("c")), "counts")


def frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The ``FREQUENT`` most frequent words at most, first ones first.

    The least count among them comes from the table of counts of counts; words with a count
    of which not all would fit are left out, so that the driver gets no more than it keeps.
    """
    running = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0)
    of_counts = counts.groupBy("c").agg(F.count("*").alias("n"))
    fits = of_counts.withColumn("upto", F.sum("n").over(running)).filter(F.col("upto") <= FREQUENT)
    least = fits.agg(F.min("c")).first()[0]
    if least is None:
        return []
    rows = counts.filter(F.col("c") >= least).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))


def total(values):
    """The sum of each column; eight rows at a time, as numpy adds up 32 numbers that lie together."""
    sums = values[:8].copy()
    for k in range(8, len(values), 8):
        sums += values[k : k + 8]
    while len(sums) > 1:
        sums = sums[::2] + sums[1::2]
    return sums[0]


def picked(logit, target):
    """Log softmax of each column at its target; ``logit`` is overwritten."""
    logit -= logit.max(0)
    found = logit[target, np.arange(len(target))]
    np.exp(logit, out=logit)
    return found - np.log(total(logit))


def loss_gradient(logit, target):
    """That of the negated log softmax of each column at its target, a row for each; ``logit`` is overwritten."""
    logit -= logit.max(0)
    np.exp(logit, out=logit)
    logit /= total(logit)
    logit[target, np.arange(len(target))] -= 1
    return logit.T.copy()


def cell(inputs, state, before, u, n):
    """What a step from the state ``before`` mixes, all in place: ``u`` becomes the gates r and z and
    the part of the state that r lets into ``n``. Gates come first in ``inputs`` and ``state`` too."""
    np.matmul(before, state, out=u)
    gates = u[:2]
    gates += inputs[:2]
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(u[0], u[2], out=n)
    n += inputs[2]
    np.tanh(n, out=n)


def mixed(u, n, before, out):
    """The state after a ``cell``."""
    np.subtract(1, u[1], out=out)
    out *= n
    u[1] *= before
    out += u[1]


def add_rows(sums, words, rows):
    """Sets ``sums`` at each word to the sum of its ``rows``. Most words have few rows: their
    first ones are added at once, then their second ones, and so on."""
    few = np.bincount(words, minlength=MODEL_WORDS) <= FEW
    key = words + few[words] * MODEL_WORDS
    order = np.argsort(key.astype(np.uint16), kind="stable")
    key, rows = key[order], rows.take(order, 0)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    size, word = np.diff(first, append=len(key)), key[first] % MODEL_WORDS
    many = int(np.searchsorted(key[first], MODEL_WORDS))
    if many:
        sums[word[:many]] = np.add.reduceat(rows[: first[many] if many < len(first) else None], first[:many])
    by_size = many + np.argsort(-size[many:], kind="stable")
    first, size, word = first[by_size], size[by_size], word[by_size]
    found = rows.take(first, 0)
    longer = int(np.searchsorted(-size, -1))
    if longer:
        others = rows.take(first[:longer] + 1, 0)
        for k in range(2, size[0]):
            n = int(np.searchsorted(-size, -k))
            others[:n] += rows.take(first[:n] + k, 0)
        found[:longer] += others
    sums[word] = found


class Network:
    """Parameters as one vector with named views.

    ``inputs`` is the input weights of the three gates for each word, ``state`` those of the
    hidden state; ``groups`` and ``words`` are the softmax over classes and inside each class.
    """

    SHAPES = {
        "inputs": (MODEL_WORDS, 3 * HIDDEN),
        "state": (HIDDEN, 3 * HIDDEN),
        "groups": (HIDDEN, CLASSES),
        "group_bias": (CLASSES,),
        "words": (CLASSES, HIDDEN, PER_CLASS),
        "word_bias": (CLASSES, PER_CLASS),
    }
    SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def initial(cls, frequency: np.ndarray) -> "Network":
        """Small random weights; the biases give the words' frequencies."""
        rng = np.random.default_rng(8)
        new = cls(rng.normal(0, 0.05, cls.SIZE).astype(np.float32))
        share = (frequency + 0.5).reshape(CLASSES, PER_CLASS)
        new.group_bias[:] = np.log(share.sum(1) / share.sum())
        new.word_bias[:] = np.log(share / share.sum(1, keepdims=True))
        new.groups[:] = new.words[:] = 0
        return new

    def by_gate(self):
        """Copies of ``inputs`` and ``state`` with the gates r, z, n first, r and z negated."""
        sign = np.array([-1, -1, 1], self.flat.dtype)[:, None, None]
        return [w.reshape(-1, 3, HIDDEN).transpose(1, 0, 2) * sign for w in (self.inputs, self.state)]

    def step(self, x, h):
        inputs, state = self.by_gate()
        u, n, out = np.empty((3, *h.shape), h.dtype), np.empty_like(h), np.empty_like(h)
        cell(inputs[:, x], state, h, u, n)
        mixed(u, n, h, out)
        return out, n

    def outputs(self, h, target, gradient=None):
        """Log probability of each target; with ``gradient``, that of the loss for ``h`` instead.

        Logits have a column for each row of ``h``, so that their maxima and sums run along memory.
        """
        group, within = np.divmod(target, PER_CLASS)
        order = np.argsort(group.astype(np.uint8), kind="stable")
        ordered, within = h.take(order, 0), within[order]
        edges = np.searchsorted(group[order], np.arange(CLASSES + 1))
        runs = [(k, slice(edges[k], edges[k + 1])) for k in range(CLASSES) if edges[k] < edges[k + 1]]
        groups = self.groups.T @ h.T
        groups += self.group_bias[:, None]
        words = np.empty((PER_CLASS, len(h)), h.dtype)
        for k, own in runs:
            np.matmul(self.words[k].T, ordered[own].T, out=words[:, own])
            words[:, own] += self.word_bias[k][:, None]
        if gradient is None:
            found = picked(groups, group)
            found[order] += picked(words, within)
            return found
        groups, words = loss_gradient(groups, group), loss_gradient(words, within)
        gradient.groups += h.T @ groups
        gradient.group_bias += groups.sum(0)
        dh = groups @ self.groups.T
        for k, own in runs:
            gradient.words[k] += ordered[own].T @ words[own]
            gradient.word_bias[k] += words[own].sum(0)
            np.matmul(words[own], self.words[k].T, out=ordered[own])
        ordered += dh.take(order, 0)
        dh[order] = ordered
        return dh


class Learner:
    """Truncated backpropagation through time with Adam steps."""

    def __init__(self, flat: np.ndarray):
        self.net = Network(flat.copy())
        self.m, self.v, self.steps = np.zeros_like(flat), np.zeros_like(flat), 0

    def learn(self, tokens: np.ndarray):
        """A batch of segments; the state goes on from window to window, the gradient doesn't."""
        h = np.zeros((len(tokens), HIDDEN), np.float32)
        for low in range(0, tokens.shape[1] - 1, TRUNCATE):
            x = tokens[:, low : low + TRUNCATE]
            y = tokens[:, low + 1 : low + 1 + TRUNCATE]
            h = self.window(x[:, : y.shape[1]], y, h)

    def learn_all(self, documents) -> int:
        """Every token of all ``documents`` once; how many there were.

        ``BATCH`` documents go side by side, a window of ``TRUNCATE`` tokens at a time. The
        state goes on from window to window to a document's end, and the next document
        starts there from zero, in the same window. Lanes without documents are dropped.
        """
        documents, seen = iter(documents), 0
        lanes, h = [(None, 0)] * BATCH, np.zeros((BATCH, HIDDEN), np.float32)
        last = np.full(BATCH, END)
        while lanes:
            y = np.full((len(lanes), TRUNCATE), END)
            fresh = np.zeros(y.shape, bool)
            length = np.zeros(len(lanes), np.int64)
            for i, (ids, at) in enumerate(lanes):
                n = 0
                while n < TRUNCATE:
                    if ids is None or at == len(ids):
                        ids, at = next(documents, None), 0
                        if ids is None:
                            break
                    take = min(TRUNCATE - n, len(ids) - at)
                    y[i, n : n + take] = ids[at : at + take]
                    if not at:
                        fresh[i, n] = True
                    at += take
                    n += take
                lanes[i], length[i] = (ids, at), n
            x = np.concatenate((last[:, None], y[:, :-1]), 1)
            x[fresh] = END
            last, real = y[:, -1], None
            if not (length == TRUNCATE).all():
                left = np.flatnonzero(length)
                lanes, h, last = [lanes[i] for i in left], h[left], last[left]
                x, y, fresh, length = x[left], y[left], fresh[left], length[left]
                real = np.arange(TRUNCATE) < length[:, None]
                x[~real] = END
            if lanes:
                h = self.window(x, y, h, fresh, real)
                seen += int(length.sum())
        return seen

    def window(self, x, y, h, fresh=None, real=None):
        """One step of learning. Where ``fresh`` the state starts anew; only ``real`` tokens count.

        Only what a step needs of the last one is computed step by step.
        """
        net, steps = self.net, x.shape[1]
        grad = Network(np.zeros_like(net.flat))
        kind, words = net.flat.dtype, x.T.reshape(-1)
        shape = (steps, len(x), HIDDEN)
        inputs, state = net.by_gate()
        inputs = inputs.take(words, 1).reshape(3, *shape)
        before, states, n = (np.empty(shape, kind) for _ in range(3))
        u = np.empty((3, *shape), kind)
        starts = {} if fresh is None else {t: np.flatnonzero(fresh[:, t]) for t in np.flatnonzero(fresh.any(0))}
        for t in range(steps):
            before[t] = h
            if t in starts:
                before[t, starts[t]] = 0
            cell(inputs[:, t], state, before[t], u[:, t], n[t])
            h = np.subtract(before[t], n[t], out=states[t])
            h *= u[1, t]
            h += n[t]
        flat, target = states.reshape(-1, HIDDEN), y.T.reshape(-1)
        if real is None:
            dh_out = net.outputs(flat, target, grad)
        else:
            at = np.flatnonzero(real.T.reshape(-1))
            dh_out = np.zeros_like(flat)
            dh_out[at] = net.outputs(flat[at], target[at], grad)
        dh_out = dh_out.reshape(shape)
        r, z, un = u
        by_z = np.subtract(before, n)  # what a change of the state changes in the sum of z, and so on
        by_z *= z
        stays = np.subtract(1, z)
        by_z *= stays
        n *= n
        dan = np.subtract(1, n, out=n)
        dan *= stays
        by_r = un
        by_r *= r
        by_r *= np.subtract(1, r, out=stays)
        dh = np.zeros(shape[1:], kind)
        du = np.empty((*shape[:2], 3 * HIDDEN), kind)
        for t in reversed(range(steps)):
            dh += dh_out[t]
            dan[t] *= dh
            np.multiply(dan[t], by_r[t], out=du[t, :, :HIDDEN])
            np.multiply(dh, by_z[t], out=du[t, :, HIDDEN : 2 * HIDDEN])
            np.multiply(dan[t], r[t], out=du[t, :, 2 * HIDDEN :])
            dh *= z[t]
            dh += du[t] @ net.state.T
            if t in starts:
                dh[starts[t]] = 0
        grad.state += before.reshape(-1, HIDDEN).T @ du.reshape(-1, 3 * HIDDEN)
        du[:, :, 2 * HIDDEN :] = dan  # now of the inputs' sums
        add_rows(grad.inputs, words, du.reshape(-1, 3 * HIDDEN))
        self.adam(grad.flat, y.size if real is None else int(real.sum()))
        return h

    def adam(self, g: np.ndarray, n: int):
        """A step by the gradient ``g`` of ``n`` tokens, which is overwritten."""
        g /= n
        square = g * g
        scale = min(1.0, 1.0 / max(float(np.sqrt(square.sum())), 1e-9))
        g *= scale
        self.steps += 1
        np.multiply(g, g, out=square)
        g -= self.m
        g *= 0.1
        self.m += g
        square -= self.v
        square *= 0.01
        self.v += square
        np.divide(self.v, 1 - 0.99**self.steps, out=square)
        np.sqrt(square, out=square)
        square += 1e-6
        np.divide(self.m, 1 - 0.9**self.steps, out=g)
        g *= RATE
        g /= square
        self.net.flat -= g


def sequence_scores(net: Network, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each sequence, whole: its state is carried to its end.

    Sequences go side by side from the longest to the shortest, a window of steps at a time.
    """
    out = np.zeros(len(sequences))
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    inputs, state = net.by_gate()
    kind, most = net.flat.dtype, min(LANES, len(order))
    states, targets = np.empty((STEPS * most, HIDDEN), kind), np.empty(STEPS * most, np.int64)
    u, new = np.empty((3, most, HIDDEN), kind), np.empty((most, HIDDEN), kind)
    for low in range(0, len(order), LANES):
        lane = order[low : low + LANES]
        length = np.array([len(sequences[i]) for i in lane])
        flat = np.concatenate([sequences[i] for i in lane]).astype(np.int64)
        begin = np.cumsum(length) - length
        running = np.searchsorted(-length, -np.arange(length[0]))  # sequences longer than each step
        total = np.zeros(len(lane))
        h = np.zeros((len(lane), HIDDEN), kind)
        x = np.full(len(lane), END)
        for first in range(0, int(length[0]), STEPS):
            edges = np.concatenate(([0], np.cumsum(running[first : first + STEPS])))
            for t, (at, to) in enumerate(zip(edges, edges[1:]), first):
                n = to - at
                cell(inputs.take(x[:n], 1), state, h[:n], u[:, :n], new[:n])
                mixed(u[:, :n], new[:n], h[:n], states[at:to])
                x, h = targets[at:to], states[at:to]
                flat.take(begin[:n] + t, out=x)
            h, x = h.copy(), x.copy()
            found = net.outputs(states[:to], targets[:to])
            for at, to in zip(edges, edges[1:]):
                total[: to - at] += found[at:to]
        out[lane] = total
    return out


class Numbers:
    """What a task knows of the ``FREQUENT`` words: their outcomes and the logs of their counts."""

    def __init__(self, words: list[tuple[bytes, int]]):
        self.words = pa.array([w for w, _ in words], pa.binary())
        rank = np.arange(len(words) + 1)
        self.own = np.where(rank + 2 < MODEL_WORDS, rank + 2, OTHER).astype("<u2")
        self.logs = np.array([log10(c + SMOOTHING) for _, c in words] + [0.0])
        self.own[-1] = OTHER  # the last place is for words that are not frequent

    def __call__(self, text: str) -> tuple:
        """Outcomes with the end; counts of frequent words and of other outcomes; sums of logs
        of frequent words and of those among the other outcomes; the words that are not frequent."""
        return tuple(c[0].as_py() for c in self.columns(pa.array([text], pa.string())))

    def columns(self, texts: pa.Array) -> list[pa.Array]:
        """The same of all ``texts``. Each distinct word is looked up once."""
        words, sizes = split(texts)
        coded = words.dictionary_encode()
        rank = pc.index_in(coded.dictionary, value_set=self.words).fill_null(len(self.words)).to_numpy()
        rank = rank.take(coded.indices.to_numpy())
        own, logs, rare = self.own.take(rank), self.logs.take(rank), rank == len(self.words)
        row = np.repeat(np.arange(len(texts)), sizes)
        edges = np.concatenate(([0], np.cumsum(sizes)))

        def count(mask):
            return np.diff(np.concatenate(([0], np.cumsum(mask)))[edges])

        def total(values):
            return pa.array(np.bincount(row, weights=values, minlength=len(texts)).astype(float))

        ids = np.full(len(own) + len(texts), END, "<u2")
        ids[np.arange(len(own)) + row] = own
        edges_ids = (2 * (edges + np.arange(len(edges)))).astype(np.int32)
        n_rare = count(rare)
        return [
            pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(edges_ids), pa.py_buffer(ids)]),
            pa.array(sizes - n_rare),
            pa.array(count(own == OTHER)),
            total(logs),
            total(np.where(own == OTHER, logs, 0)),
            pc.binary_join(lists(words.filter(pa.array(rare)), n_rare), b" "),
        ]


def numbered(rows: DataFrame, words: list[tuple[bytes, int]]) -> DataFrame:
    """Every document's outcomes and sums, from one reading of its words; written once.

    ``round`` is the one that learns from the document.
    """
    shared = rows.sparkSession.sparkContext.broadcast(Numbers(words))
    names = ["ids", "frequent", "others", "base", "other", "rare"]

    def run(batches):
        number = shared.value
        for batch in batches:
            kept = {c: batch[c] for c in ("rid", "doc_id", "held_out", "round")}
            yield {**kept, **dict(zip(names, number.columns(batch["text"])))}

    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).cast("int").alias("round")
    keyed = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", turn, "text")
    schema = (
        "rid bigint, doc_id bigint, held_out boolean, round int, ids binary, frequent bigint, "
        "others bigint, base double, other double, rare binary"
    )
    return staged(map_batches(keyed, run, schema), "tokens")


def averaged(parts: DataFrame) -> np.ndarray | None:
    """The mean of vectors ``flat`` by ``weight``: sums of ``VECTORS`` at a time, until as few
    are left for the driver."""

    def run(batches):
        total, weight = None, 0
        for batch in batches:
            for w, flat in zip(batch["weight"].to_pylist(), batch["flat"]):
                values = flat.values.to_numpy() * w
                total = values if total is None else total + values
                weight += w
        if total is not None:
            yield {"weight": [weight], "flat": [total / weight]}

    schema = "weight bigint, flat array<double>"
    while True:
        parts = staged(parts, "weights")
        n = parts.count()
        if n <= VECTORS:
            break
        parts = map_batches(parts.coalesce(-(-n // VECTORS)), run, schema)
    rows = parts.collect()
    if not rows:
        return None
    return np.average([r["flat"] for r in rows], axis=0, weights=[r["weight"] for r in rows])


def train(tokens: DataFrame, frequency: np.ndarray) -> np.ndarray:
    """The network after ``ROUNDS`` of parallel learning on all the training documents.

    Every token of every document is learnt from in one round, with the state of all tokens
    before it. The tasks of a round learn apart, from the same start, and their weights are
    averaged by the tokens they saw.
    """
    flat = Network.initial(frequency).flat
    for k in range(ROUNDS):
        start = tokens.sparkSession.sparkContext.broadcast(flat)

        def learn(batches):
            learner = Learner(start.value)
            seen = learner.learn_all(
                np.frombuffer(raw, "<u2") for batch in batches for raw in batch.column(0).to_pylist()
            )
            if seen:
                yield {"weight": [seen], "flat": [learner.net.flat.astype(np.float64)]}

        own = tokens.filter((F.col("round") == k) & ~F.col("held_out")).select("ids")
        mean = averaged(map_batches(own, learn, "weight bigint, flat array<double>"))
        if mean is not None:
            flat = mean.astype(np.float32)
    return flat


def lm_scores(docs: DataFrame) -> DataFrame:
    """Per document: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score``, the network's log10 probability of the whole text.

    Word counts cover every training document. The network predicts the most frequent words,
    the end and a common outcome for other words; one of those is then drawn by its smoothed
    count among them, so a text's probability is a product over its tokens. Counts of the
    ``FREQUENT`` most frequent words go to every task, of the others by a join on the word.
    Documents are numbered once; learning and scoring read the numbers.

    Null and empty texts are one token, the end. Without training documents every count is
    zero and the network stays as it began. Repeated rows come out repeated; an empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    held = remainder(FOLDS) == HELD_OUT
    rows = texts(docs).withColumn("held_out", held)
    training = rows.filter("NOT held_out")
    counts = word_counts(training)
    n_docs = training.select("doc_id").count()
    n_words, v_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, v = n_words + n_docs, v_words + (n_docs > 0)
    common = frequent(counts)
    frequency = np.zeros(MODEL_WORDS)
    own = np.array([c for _, c in common[: MODEL_WORDS - 2]])
    frequency[2 : 2 + len(own)] = own
    frequency[OTHER], frequency[END] = n_words - frequency[2:].sum(), n_docs
    outside = frequency[OTHER] + SMOOTHING * (v_words - (frequency[2:] > 0).sum() + 1)
    tokens = numbered(rows, common)
    shared = spark.sparkContext.broadcast(train(tokens, frequency))
    kept = ["rid", "doc_id", "held_out", "frequent", "others", "base", "other"]

    def run(batches):
        net = Network(shared.value)
        waiting, sequences, size = [], [], 0

        def flush():
            found = sequence_scores(net, sequences) / np.log(10)
            columns = dict(zip(kept, map(list, zip(*waiting))))
            return {**columns, "n_tokens": [len(ids) for ids in sequences], "model": found}

        for batch in batches:
            *columns, raw = (c.to_pylist() for c in batch.columns)
            waiting.extend(zip(*columns))
            sequences.extend(np.frombuffer(r, "<u2") for r in raw)
            size += sum(len(r) // 2 for r in raw)
            if size > TASK_TOKENS:
                yield flush()
                waiting, sequences, size = [], [], 0
        if waiting:
            yield flush()

    schema = (
        "rid bigint, doc_id bigint, held_out boolean, frequent bigint, others bigint, "
        "base double, other double, n_tokens bigint, model double"
    )
    scored = staged(map_batches(tokens.select(*kept, "ids"), run, schema), "scored")
    rare = (
        tokens.filter("octet_length(rare) > 0")
        .select("rid", F.explode(F.split(F.col("rare").cast("string"), " ")).alias("word"))
        .join(counts.select(F.col("word").cast("string"), "c"), "word", "left")
        .groupBy("rid")
        .agg(
            F.sum(F.log10(F.coalesce("c", F.lit(0)) + SMOOTHING)).alias("rare_sum"),
            F.count("c").alias("rare_known"),
        )
    )
    none = F.lit(0)
    rare_sum = F.coalesce("rare_sum", none.cast("double"))
    known_end = int(n_docs > 0)
    base = F.col("base") + F.lit(log10(n_docs + SMOOTHING)) + rare_sum
    return scored.join(rare, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("frequent") + F.coalesce("rare_known", none) + known_end).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (base - F.col("n_tokens") * log10(n + SMOOTHING * (v + 1))).alias("base_score"),
        (F.col("model") + F.col("other") + rare_sum - F.col("others") * log10(outside)).alias("score"),
    )

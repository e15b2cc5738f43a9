"""Spelling variants: words one edit apart, found through pairs of trie nodes."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lists, map_batches, staged

# --- Fixed values: the contract's words, damage and thresholds ---
LEAST_LETTERS = 7
RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LETTERS)  # in Latin-1, lower-cased
DAMAGE_EVERY = 31
LEAST_COUNT = 2
TIMES_COMMONER = 10
# --- End of fixed values ---

HELD_WORDS = 300_000  # distinct words that a task counts before it hands them on
PIECE = 1 << 40  # numbers of one task's words and nodes
PAIRS = 100_000  # rows that are grouped at once


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, of words seen twice or more.

    A run is looked at in Latin-1, where each of its letters is one byte and everything else
    beyond Latin-1 becomes a question mark, which parts runs as the letter did.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text"
    ).filter("text IS NOT NULL")

    def told(counts: Counter) -> dict:
        return {"word": [w.decode("latin-1") for w in counts], "n": list(counts.values())}

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                start = zlib.crc32(f"{doc_id}:".encode())
                for run_ in RUN.findall(text.encode("latin-1", "replace").lower()):
                    utf8 = run_ if run_.isascii() else run_.decode("latin-1").encode()
                    h = zlib.crc32(utf8, start)
                    if h % DAMAGE_EVERY == 0:
                        at = h % len(run_)
                        run_ = run_[:at] + run_[at + 1 :]
                        if len(run_) < LEAST_LETTERS:
                            continue
                    counts[run_] += 1
            if len(counts) > HELD_WORDS:
                yield told(counts)
                counts = Counter()
        if counts:
            yield told(counts)

    partial = map_batches(rows, run, "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _shared(a: str, b: str) -> int:
    """Letters that two words begin with alike."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Words of a sorted partition with the numbers of the trie nodes on their way.

    A node's number is the task's, then a counter; those on the first word's path are counted
    by depth, so that ``numbered`` can find the ones other tasks have numbered too.
    """
    first = TaskContext.get().partitionId() * PIECE
    before, path, count, seen = "", [first], None, 0
    for batch in batches:
        words = batch["word"].to_pylist()
        flat, sizes, ids = [], [], []
        for word in words:
            if count is None:
                path = list(range(first, first + len(word) + 1))
                count = first + len(word) + 1
            else:
                path = path[: _shared(before, word) + 1]
                new = len(word) + 1 - len(path)
                path.extend(range(count, count + new))
                count += new
            flat.extend(path)
            sizes.append(len(path))
            ids.append(first + seen)
            seen += 1
            before = word
        yield {
            "word": batch["word"],
            "key": batch["key"],
            "n": batch["n"],
            "place": pa.array(ids, pa.int64()),
            "nodes": lists(np.array(flat, np.int64), sizes),
        }


def numbered(words: DataFrame, name: str) -> DataFrame:
    """``word``, ``key``, ``n`` with ``place`` (rises with the word) and ``nodes``, its trie path.

    ``nodes[d]`` numbers the trie node of the first d letters: two words have the same number
    there if and only if they begin with the same d letters. Words are distinct, and range
    partitions are walked in order, so a node is shared by neighbours in the order. One whose
    words span partitions is on the last path of the one and the first path of the next; the
    two words at every border (two rows a task reach the driver) tell which numbers are one.
    """
    spark = words.sparkSession
    placed = words.repartitionByRange("word").sortWithinPartitions("word")
    walked = staged(
        map_batches(
            placed.select("word", "key", "n"),
            _walk,
            "word string, key bigint, n bigint, place bigint, nodes array<bigint>",
        ),
        name,
    )
    piece = F.floor(F.col("place") / PIECE)
    ends = walked.groupBy(piece.alias("piece")).agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )
    border = ends.select(F.explode(F.array("first", "last")).alias("place")).distinct()
    rows = sorted(
        walked.join(F.broadcast(border), "place").select("place", "word", "nodes").collect()
    )
    same, last = [], None
    paths: dict[int, list[int]] = {}
    for place, word, nodes in rows:
        piece_no = place // PIECE
        if piece_no not in paths:
            paths[piece_no] = last[1][: _shared(last[0], word) + 1] if last else []
            same.append((piece_no, paths[piece_no]))
        own = paths[piece_no]
        nodes = [own[d] if d < len(own) and x == piece_no * PIECE + d else x for d, x in enumerate(nodes)]
        last = (word, nodes)
    known = spark.createDataFrame(same, "piece bigint, own array<bigint>")
    renumbered = F.transform(
        "nodes",
        lambda x, d: F.when(
            (d < F.size("own")) & (x == F.col("piece") * F.lit(PIECE) + d), F.get("own", d)
        ).otherwise(x),
    )
    return (
        walked.withColumn("piece", piece)
        .join(F.broadcast(known), "piece")
        .select("word", "key", "n", "place", renumbered.alias("nodes"))
    )


def node_pairs(words: DataFrame) -> DataFrame:
    """Per word and split: numbers of the node before (``p``) and after (``s``).

    ``kind`` 0: nothing is left out; 1: a letter is left out; 2: the same letter as the one
    before it is left out, which leaves a word that the one before has left already.
    """
    forward, backward = words
    joined = forward.join(
        backward.select(F.col("key").alias("place"), F.col("nodes").alias("ends")), "place"
    )
    letters = F.split("word", "")

    def left_out(i):
        doubled = (i > 0) & (F.get("letters", i) == F.get("letters", i - 1))
        return F.struct(
            F.get("nodes", i).alias("p"),
            F.get("ends", F.col("size") - 1 - i).alias("s"),
            F.when(doubled, 2).otherwise(1).alias("kind"),
        )

    def whole(i):
        return F.struct(
            F.get("nodes", i).alias("p"),
            F.get("ends", F.col("size") - i).alias("s"),
            F.lit(0).alias("kind"),
        )

    every = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("size") - 1), left_out),
        F.transform(F.sequence(F.lit(0), F.col("size")), whole),
    )
    return (
        joined.withColumn("letters", letters)
        .withColumn("size", F.length("word"))
        .select("place", "n", F.inline(every))
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Per word and pair: how many words it meets there, and the best of them.

    Rows are sorted by pair, the words that left a letter out first, by count and word. A pair
    has one word per letter at most and one that is whole, so no group is large.
    """

    def grouped(t: dict, known: int) -> dict:
        p, s, kind, n, place = (t[c][:known] for c in ("p", "s", "kind", "n", "place"))
        new = np.empty(known, bool)
        new[0] = True
        new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1])
        group = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        out = kind > 0
        n_out = np.bincount(group, out, len(start)).astype(np.int64)
        n_first = np.bincount(group, kind == 1, len(start)).astype(np.int64)
        size = np.bincount(group, minlength=len(start))
        whole = size - n_out  # 0 or 1, and then the last row
        end = start + size - 1
        # For a word with a letter left out: others with one, best first, and the whole word.
        lead = np.where(np.arange(known) == start[group], np.minimum(start[group] + 1, known - 1), start[group])
        met = np.where(out, n_out[group] - 1, 0)
        best_n = np.where(out & (met > 0), n[lead], 0)
        best = np.where(out & (met > 0), place[lead], -1)
        meets_whole = (kind == 1) & (whole[group] == 1)
        w_n, w_at = n[end[group]], place[end[group]]
        better = meets_whole & ((w_n > best_n) | ((w_n == best_n) & (w_at < best)))
        best_n, best = np.where(better, w_n, best_n), np.where(better, w_at, best)
        met = met + meets_whole
        # For a whole word: those that leave a new word, the first of which is the best.
        firsts = np.flatnonzero(kind == 1)
        at = np.searchsorted(firsts, start)
        lead_first = firsts[np.minimum(at, max(len(firsts) - 1, 0))] if len(firsts) else start
        is_whole = (~out) & (n_first[group] > 0)
        met = np.where(is_whole, n_first[group], met)
        best_n = np.where(is_whole, n[lead_first[group]], best_n)
        best = np.where(is_whole, place[lead_first[group]], best)
        some = met > 0
        return {"place": place[some], "met": met[some].astype(np.int64), "best_n": best_n[some], "best": best[some]}

    held: list[dict] = []
    rows = 0

    def gathered() -> dict:
        return {c: np.concatenate([h[c] for h in held]) for c in held[0]}

    for batch in batches:
        held.append({c: batch[c].to_numpy() for c in ("p", "s", "kind", "n", "place")})
        rows += batch.num_rows
        if rows < PAIRS:
            continue
        t = gathered()
        last = np.flatnonzero((t["p"] != t["p"][-1]) | (t["s"] != t["s"][-1]))
        known = int(last[-1]) + 1 if len(last) else 0
        if known:
            yield grouped(t, known)
        held, rows = [{c: v[known:] for c, v in t.items()}], rows - known
    if rows:
        yield grouped(gathered(), rows)


def near_words(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """``place``, ``n_near`` and the best near word (``best_n``, ``best``) of words that have one."""
    pairs = node_pairs((forward, backward))
    order = [F.asc("p"), F.asc("s"), (F.col("kind") == 0).asc(), F.desc("n"), F.asc("place")]
    sorted_ = pairs.repartition("p", "s").sortWithinPartitions(*order).select("p", "s", "kind", "n", "place")
    met = map_batches(sorted_, _neighbours, "place bigint, met bigint, best_n bigint, best bigint")
    best = F.max(F.struct(F.col("best_n").alias("n"), (-F.col("best")).alias("at")))
    return (
        met.groupBy("place")
        .agg(F.sum("met").alias("n_near"), best.alias("b"))
        .select("place", "n_near", F.col("b.n").alias("best_n"), (-F.col("b.at")).alias("best"))
    )


def roots(forms: DataFrame, most: int) -> DataFrame:
    """``place`` and ``root`` of forms' chains by pointer doubling; ``most`` is the largest count.

    A form is ten times as frequent, so a chain has at most log10(``most``) links, and half as
    many remain after each round.
    """
    length = max(1, len(str(most)) - 1)
    found = staged(forms.select("place", F.col("form").alias("root")), "roots")
    while length > 1:
        further = found.select(F.col("place").alias("root"), F.col("root").alias("further"))
        found = staged(
            found.join(further, "root", "left").select(
                "place", F.coalesce("further", "root").alias("root")
            ),
            "roots",
        )
        length = -(-length // 2)
    return found


def variants(docs: DataFrame) -> DataFrame:
    """Per word: its count ``n``, ``n_near`` near words, ``form``, ``form_n`` and ``root``.

    Words are near if one letter inserted, deleted or replaced makes one from the other. Nodes
    of the words' trie and of the reversed words' trie are numbered, and a word is split at
    every letter into the node before and the node after it, with and without that letter.
    Words that meet in a pair are near, and exactly the near ones meet: replaced letters where
    both left one out, an inserted letter where one left it out and the other is whole. Nothing
    is verified afterwards and no text is compared.

    Null texts and texts without words give none, null ids count as empty in the damage, rows
    repeated count again; words of any length work. An empty table gives an empty result;
    other columns are not read.
    """
    counted = word_counts(docs)
    forward = numbered(counted.withColumn("key", F.lit(0).cast("bigint")), "forward")
    backward = numbered(
        forward.select(F.reverse("word").alias("word"), F.col("place").alias("key"), "n"), "backward"
    )
    near = staged(near_words(forward, backward), "near")
    words = forward.select("word", "place", "n")
    judged = staged(
        words.join(near, "place", "left").withColumn(
            "form", F.when(F.col("best_n") >= TIMES_COMMONER * F.col("n"), F.col("best"))
        ),
        "judged",
    )
    forms = judged.filter("form IS NOT NULL").select("place", "form", F.col("best_n").alias("form_n"))
    most = judged.agg(F.max("n")).first()[0] or 1
    chained = forms.join(roots(forms, most), "place")
    spelt = words.select(F.col("place").alias("form"), F.col("word").alias("form_word"))
    spelt_root = words.select(F.col("place").alias("root"), F.col("word").alias("root_word"))
    named = chained.join(spelt, "form").join(spelt_root, "root").select(
        "place", "form_word", "root_word", "form_n"
    )
    return judged.select("word", "n", "place", "n_near").join(named, "place", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        "form_n",
    )

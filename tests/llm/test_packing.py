"""Packing: an exact round trip, and the pipeline."""

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm.corpus import COLUMNS, FOLDER, awkward, prose, table
from tidemark.llm import packing


def ids_of(texts):
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    return [np.array([*e.ids, 2], "<u4") for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def assert_whole(rows, pieces):
    """Each id lies in one piece, each sequence is gapless and needs no padding."""
    ids = {i: x for (i, _), x in zip(rows, ids_of(t or "" for _, t in rows))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
        assert p["doc_tokens"] == len(ids[p["doc_id"]])
    assert set(by_doc) == set(ids)
    for i, cuts in by_doc.items():
        at = 0
        for start, length in sorted(cuts):
            assert start == at
            at += length
        assert at == len(ids[i])
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW and at & (at - 1) == 0


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 16)
    rows = [(i, t) for i, t in awkward() if i and i != 12] + [(100 + i, prose(i, 400)) for i in range(60)]
    rows += [(300, "Don't <|endoftext|> stop… İstanbul's. 'S x'S'. <|EndOfText|>. á. 1,000.50")]
    assert_whole(rows, packing.pack(table(spark, rows, extra=True)).collect())


def test_repeated_rows_and_null_ids_are_documents(spark):
    pieces = packing.pack(table(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, None)])).collect()
    assert sum(p["length"] for p in pieces) == 3 + 3 + 2 + 1
    assert packing.pack(table(spark, [])).collect() == []


def test_scores_equal_the_formula():
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 40, n).astype("<u4") for n in (5, 30, 60, 12)]
    idf = rng.random(50)
    shard = packing.Shard(docs, idf, 25.0)
    for q in range(len(docs)):
        want = [
            sum(
                idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / 25.0))
                for t in set(docs[q].tolist())
                if (tf := int((d == t).sum()))
            )
            for d in docs
        ]
        assert np.allclose(shard.scores(q), want)


def test_a_windows_documents_are_the_seeds_best_unused_ones():
    """Every choice of a shard against all scores, computed anew."""
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 60, rng.integers(200, 1500)).astype("<u4") for _ in range(40)]
    sizes = [len(d) for d in docs]
    shard = packing.Shard(docs, rng.random(60), 800.0)
    order = list(packing.reading_order(shard, sizes, packing.WINDOW))
    assert sorted(order) == list(range(40))
    used, seed, room = set(), None, packing.WINDOW
    for k in order:
        if seed is not None:
            scores = shard.scores(seed)
            left = [j for j in range(40) if j not in used]
            assert scores[k] == max(scores[j] for j in left)
        used.add(k)
        seed = k if seed is None else seed
        room -= sizes[k]
        if room <= 0:
            seed, room = (k if room < 0 else None), packing.WINDOW - (-room) % packing.WINDOW


def test_words_ids_are_the_tokenizers(spark, monkeypatch):
    """Odd strings, and the table's documents, also where the memory is cleared all the time."""
    rng = random.Random(8)
    odd = "aZé ÉßſİıĀ\u0301\u0308ﬁ光ไ.,'!<|>_-09٣½ \t\n\u00a0\u2028\u200b\U0001f600"
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    words = packing.WordIds(packing.vocabulary_path())
    want = ids_of(texts)
    for most in (packing.MOST_WORDS, 5):
        monkeypatch.setattr(packing, "MOST_WORDS", most)
        for low in range(0, len(texts), 500):
            for mine, theirs, text in zip(words.encode(texts[low : low + 500]), want[low:], texts[low:]):
                assert mine.tolist() == theirs.tolist(), repr(text)


def test_neighbours_share_a_window():
    """Documents of one subject go to one window."""
    docs = [np.arange(1000) % 50 + 100 * (k % 2) for k in range(8)]
    shard = packing.Shard([d.astype("<u4") for d in docs], np.ones(300), 1000.0)
    order = list(packing.reading_order(shard, [1024] * 8, packing.WINDOW))
    assert sorted(order) == list(range(8))
    assert len({k % 2 for k in order[:4]}) == 1


def test_pipeline_stages_take_effect(spark, tmp_path):
    """Each stage against what it must drop, on documents made for it."""
    item = prose(77, 40)
    leak = prose(8, 60) + " " + item + " " + prose(9, 60)
    near = prose(10, 500).split()
    rows = [(i, prose(100 + i, 80), "en") for i in range(40)]
    rows += [
        (50, None, "en"),
        (51, "123 456", "en"),
        (60, prose(1, 50), "en"),
        (61, prose(1, 50).replace(" ", "  "), "en"),
        (70, " ".join(near), "en"),
        (71, " ".join([*near[:250], *near[251:]]), "en"),
        (80, leak, "en"),
    ]
    folder = str(tmp_path / "tables")
    table(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder).cache()
        kept[name] = {r["doc_id"] for r in docs.collect()}
        if name != "packing":
            assert docs.columns == COLUMNS
    everything = {r[0] for r in rows}
    assert kept["language_id"] == everything - {50, 51}
    assert kept["exact_dedup"] == kept["language_id"] - {61}
    from llm.test_dedup import plain_fingerprint

    distance = (plain_fingerprint(rows[-3][1]) ^ plain_fingerprint(rows[-2][1])).bit_count()
    assert kept["simhash"] == kept["exact_dedup"] - ({71} if distance <= 2 else set())
    assert kept["decontamination"] == kept["simhash"] - {80}
    assert kept["packing"] == kept["decontamination"]


def test_a_document_without_an_id_is_kept_if_its_text_is_its_own(spark):
    from tidemark.llm import exact_dedup, simhash

    rows = [(1, prose(1, 50)), (None, prose(2, 50)), (2, prose(1, 50))]
    for module in (exact_dedup, simhash):
        kept = module.stage(spark, table(spark, rows), "").collect()
        assert sorted(str(r["doc_id"]) for r in kept) == ["1", "None"]


def test_one_row_of_each_text_stays_whatever_its_id(spark):
    """Repeated ids, the same id with another text, and copies without an id."""
    from tidemark.llm import exact_dedup, simhash

    a, b, c = prose(1, 50), prose(2, 50), prose(3, 50)
    rows = [(1, a), (1, a), (1, b), (2, b), (None, c), (None, c), (None, a), (None, b), (3, a)]
    for module in (exact_dedup, simhash):
        kept = module.stage(spark, table(spark, rows, extra=True), "").collect()
        assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("1", a), ("1", b), ("None", c)])


@pytest.mark.parametrize("extra", [False, True])
def test_pipeline_on_awkward_rows(spark, extra):
    docs = table(spark, awkward(), extra)
    folder = "/root/testdata/sf0.001"
    for name, function in corpus_pipeline.STAGES:
        before = docs.columns
        docs = function(spark, docs, folder)
        if name != "packing":
            assert docs.columns == before
    assert docs.count() > 0


def test_a_run_leaves_its_last_table_alone(spark, tmp_path):
    folder, shared = str(tmp_path / "tables"), spark.conf.get("spark.checkpoint.dir")
    table(spark, [*awkward(), *[(100 + i, prose(i, 90)) for i in range(30)]]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, prose(900, 20))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    before = set(os.listdir(shared))
    rows = corpus_pipeline.run(spark, folder)
    left = set(os.listdir(shared)) - before
    assert [name.split("-")[0] for name in left if "-" in name] == ["packing"]
    assert rows.count() > 30


def test_pipeline_of_nothing(spark):
    docs = table(spark, [])
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, "/root/testdata/sf0.001")
    assert docs.collect() == []

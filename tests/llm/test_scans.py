"""Decontamination, personal data and licence scans."""

import random
import re
from collections import Counter
from hashlib import sha256

import pytest
import regex
from compare import assert_same  # noqa: F401  (the path of the tests is set up)

from llm.corpus import awkward, prose, table
from tidemark.llm import decontaminate, licenses, pii


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_infix_distance_equals_the_table():
    rng = random.Random(4)
    for _ in range(200):
        a = "".join(rng.choices("abc ", k=rng.randint(1, 20)))
        b = "".join(rng.choices("abc ", k=rng.randint(0, 40)))
        assert decontaminate.infix_distance(a, b)[0] == plain_distance(a, b)


def edited(text, edits, seed):
    rng = random.Random(seed)
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[at] = rng.choice("abcdefgh")
        elif kind < 0.7:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcdefgh"))
    return "".join(chars)


def leaks(spark, share, n=60):
    """Recall on documents that hold an item with so many edits, and what else was found."""
    items = [(k, prose(1000 + k, 20 + k % 30)) for k in range(n)]
    benchmark = spark.createDataFrame(items + [(998, None), (999, " ")], "item_id bigint, text string")
    docs, want = [], set()
    for k, text in items:
        bad = edited(text, int(len(text) * share), k)
        docs.append((k, prose(2000 + k, 80) + " " + bad + "\n" + prose(3000 + k, 80)))
        body = decontaminate.normalise(docs[-1][1])
        if 1 - plain_distance(text, body) / len(text) >= decontaminate.SIMILARITY:
            want.add((k, k))
    docs += [(5000 + i, prose(5000 + i, 200)) for i in range(20)]
    docs += [(None if i is None else 6000 + i, t) for i, t in awkward()]  # also long, and repeated
    docs += [(None, items[0][1]), (7000, items[1][1]), (7000, items[1][1])]
    found = decontaminate.contaminated(table(spark, docs, extra=True), benchmark).collect()
    got = Counter((r["doc_id"], r["item_id"]) for r in found)
    assert got.pop((None, 0)) == 1 and got.pop((7000, 1)) == 2
    assert set(got) <= want and set(got.values()) <= {1}
    return len(got) / len(want)


def test_leaks_are_found(spark):
    assert leaks(spark, 0.0) == 1.0
    assert leaks(spark, 0.05) >= 0.98
    assert leaks(spark, 0.10) >= 0.95


@pytest.mark.parametrize("words", [6, 12, 25, 60])
@pytest.mark.parametrize("share", [0.05, 0.1, 0.15, 0.18, 0.2])
def test_recall_over_lengths_and_edits(words, share):
    """Of items so edited that similarity stays 0.8 or more, nine tenths are found."""
    items = [(k, prose(1000 * words + k, words)) for k in range(80)]
    find = decontaminate.finder(decontaminate.Index(items))
    found = wanted = 0
    for k, text in items:
        bad = edited(text, int(len(text) * share), k)
        doc = f"{prose(2000 + k, 80)} {bad}\n{prose(3000 + k, 80)}"
        distance, _ = decontaminate.infix_distance(text, decontaminate.normalise(doc))
        if 1 - distance / len(text) >= decontaminate.SIMILARITY:
            wanted += 1
            found += any(hit[0] == k for hit in find([doc])[0])
    assert wanted > 40 and found >= 0.9 * wanted


def test_two_items_in_one_place_are_both_found():
    text = prose(77, 30)
    find = decontaminate.finder(decontaminate.Index([(1, text), (2, text), (3, text.upper())]))
    assert [h[0] for h in find([f"{prose(1, 9)} {text} {prose(2, 9)}"])[0]] == [1, 2, 3]


def test_coins_and_samples_of_a_walk():
    """A walk writes the character it stands on and moves one or none; ends repeat themselves."""
    raw = decontaminate.characters(["some words of a text to walk along", "x"])
    codes = decontaminate.coded(raw)
    embedding = decontaminate.Embedding()
    starts = decontaminate.window_starts(raw)
    for walk in range(decontaminate.WALKS):
        written = embedding.walk(codes, starts, walk, decontaminate.STEPS)
        for k, start in enumerate(starts):
            at = int(start)
            for step in range(decontaminate.STEPS):
                assert written[step, k] == codes[at]
                at += (int(codes[at]) * int(embedding.coins[walk, step]) % 256) >> 7
        assert (written[-1, -1:] == 0).all()


def test_no_benchmark_no_documents(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contaminated(table(spark, [(1, "a")]), none).collect() == []
    some = spark.createDataFrame([(1, prose(1, 30))], "item_id bigint, text string")
    assert decontaminate.contaminated(table(spark, []), some).collect() == []


def test_short_items(spark):
    items = spark.createDataFrame([(1, "the quick brown"), (2, "fox")], "item_id bigint, text string")
    docs = [(1, prose(1, 40) + " The  quick\nbrown " + prose(2, 40)), (2, prose(3, 50))]
    got = decontaminate.contaminated(table(spark, docs), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got if r["item_id"] == 1} == {(1, 1)}


def test_short_items_at_every_word_and_in_unspaced_text():
    """Exact copies at odd and even words, and of the shortest with an edit, all found."""
    items = ["fox", "banana", "explain photosynthesis", "thermodynamics is the study of heat, work",
             "characteristically the committee of the whole house met on the day of the vote",
             "光合作用是植物利用光能把二氧化碳和水转化为有机物的过程", "การสังเคราะห์ด้วยแสงคืออะไร"]
    find = decontaminate.finder(decontaminate.Index(list(enumerate(items))))
    for k, item in enumerate(items):
        for lead in range(6):
            texts = [f"{prose(10 + lead, lead)} {item} {prose(20, 30)}"]
            if not item.isascii():
                texts.append("我们今天学习的内容" * lead + item + "以及其他的内容")
            if item == "banana":
                texts.append(f"{prose(10 + lead, lead)} banxna {prose(20, 30)}")
            for hits in find(texts):
                assert k in {h[0] for h in hits}, (item, lead)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(d[::-1])) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "a@b.c_d@e.f x@y.z-w@v.u a@@b.c .@.a.b a@b..c a@b.c.",
    "😀 me@home.example.com, é1.2.3.4 001.002.003.0255 1.2.3.4.5.6.7.8 256.1.1.1 0000000000000001.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111110 79927398713",
    "4111 1111 1111 1111-4111 1111 1111 1111 " + "1 " * 3000,
    "+1 (988) 555-2485. +44.20.7946.0958) +1 2 +123456789012345678 ++49 30 1234567 +1-+1 555 123 4567",
    "\x01\x02 4111\x011111 1111 1111 5500 0000 0000 0004\x01",
    "9" * 4000 + "@x.y " + "a" * 20_000 + "@" + "b" * 100,
]


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, t in enumerate(TRICKY)]
    alphabet = "ab1234567890 .-@+()_%\x01é😀"
    rows += [(100 + i, "".join(rng.choices(alphabet, k=200))) for i in range(200)]
    rows += [(400 + i, t) for i, (_, t) in enumerate(awkward())] + [(None, TRICKY[0])]
    got = {r["doc_id"]: r for r in pii.personal_data(table(spark, rows, extra=True)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        base = plain_base(text)
        assert got[doc_id]["base_sha256"] == sha256(",".join(base).encode()).hexdigest(), text[:80]
        assert got[doc_id]["spans"].split(",")[: len(base)] == base or not base
        for kind in PATTERNS:
            assert got[doc_id][f"n_{kind}"] == sum(b.startswith(kind) for b in base)


def plain_revealing(rows):
    """Words whose smoothed information about an entity of their documents is too high."""
    docs = []
    for _, text in rows:
        spans = [tuple(map(int, b.split(":")[1:])) + (b.split(":")[0],) for b in plain_base(text)]
        body = list(text or "")
        entities = set()
        for start, end, kind in spans:
            value = (text or "")[start:end]
            digits = re.sub("[^0-9]", "", value)
            name = {"email": value.lower(), "ip": value, "card": digits, "phone": "+" + digits}[kind]
            entities.add((kind, name))
            body[start:end] = " " * (end - start)
        words = regex.findall(r"[\p{L}\p{M}\p{N}]+", "".join(body))
        docs.append((entities, {w.lower() for w in words}, "".join(body)))
    n, found = len(docs), set()
    holding, having = Counter(), Counter()
    for entities, words, _ in docs:
        holding.update(entities)
        having.update(words)
    both = Counter((e, w) for entities, words, _ in docs for e in entities for w in words)
    for (e, w), together in both.items():
        share = holding[e] / n
        given = (together + pii.SMOOTHING * share) / (having[w] + pii.SMOOTHING)
        if holding[e] < n and given >= share ** (1 - pii.DISCLOSURE):
            found.add(w)
    return [
        [(m.start(), m.end()) for m in regex.finditer(r"[\p{L}\p{M}\p{N}]+", body) if m[0].lower() in found]
        for _, _, body in docs
    ]


def term_spans(row):
    return [tuple(map(int, s.split(":")[1:])) for s in row["spans"].split(",") if s.startswith("term:")]


@pytest.mark.parametrize("searched", [1000, 2])
def test_revealing_words_equal_plain_counts(spark, monkeypatch, searched):
    """Shared and single entities, words of many scripts, tricky spans, nulls and long texts."""
    monkeypatch.setattr(pii, "MOST_SEARCHED", searched)
    rng = random.Random(11)
    vocabulary = [prose(500 + i, 1) for i in range(150)] + ["Привет", "ΛΌΓΟΣ", "光合作用", "naïve", "42", "İstanbul"]
    people = [f"user{i}@mail.example.org" for i in range(12)] + ["+49 30 123456789", "10.1.2.3"]
    rows = []
    for i in range(250):
        words = rng.choices(vocabulary, k=rng.randint(1, 30))
        if rng.random() < 0.3:
            words.insert(rng.randrange(len(words)), people[int(len(people) * rng.random() ** 2)])
            words += [f"only{i}"] * rng.randint(0, 2)
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, t) for i, t in enumerate(TRICKY)] + [(2000 + i, t) for i, (_, t) in enumerate(awkward())]
    got = {r["doc_id"]: r for r in pii.personal_data(table(spark, rows, extra=True)).collect()}
    want = plain_revealing(rows)
    assert sum(map(len, want)) > 20
    for (doc_id, _), spans in zip(rows, want):
        assert term_spans(got[doc_id]) == spans, doc_id
        assert got[doc_id]["n_term"] == len(spans)


def test_words_that_disclose_an_entity(spark):
    """In one document of an entity, 200 characters away; and in documents without the entity."""
    filler = [(i, "common words stand here and there " + prose(i, 30)) for i in range(300)]
    told = [
        (900, f"common words Zanzibar {prose(7, 60)} from zed@x.example.com there and zanzibar"),
        *[(901 + i, "words and Βόλος there +49 30 5550 100 here") for i in range(3)],
        (910, "words stand Βόλος and here"),
    ]
    rows = {r["doc_id"]: r for r in pii.personal_data(table(spark, filler + told)).collect()}
    text = told[0][1]
    assert text.index("zed@") - text.index("Zanzibar") > 200
    assert {(13, 21), (len(text) - 8, len(text))} <= set(term_spans(rows[900]))
    assert (0, 6) not in term_spans(rows[900])
    for doc_id in (901, 902, 903):
        assert term_spans(rows[doc_id]) == [(10, 15)]
    assert term_spans(rows[910]) == [(12, 17)] and rows[910]["n_phone"] == 0
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(table(spark, filler + told)).collect()}
    assert "anzibar" not in clean[900] and "[EMAIL]" in clean[900] and "zed@" not in clean[900]
    assert clean[900].startswith("common words ") and clean[5] == filler[5][1]
    assert clean[901] == "words and  there [PHONE] here" and clean[910] == "words stand  and here"


def test_redaction_keeps_rows_without_or_with_repeated_ids(spark):
    rows = [(None, "a b@c.de"), (None, None), (4, "same"), (4, "same"), (5, "1.2.3.4@x.y")]
    got = [(r["doc_id"], r["text"]) for r in pii.redacted(table(spark, rows)).collect()]
    assert len(got) == 5 and sorted(t for i, t in got if i == 4) == ["same", "same"]
    assert [t for i, t in got if i == 5] == ["[IP]"]  # what overlaps it is gone as well


def test_personal_data_in_nothing(spark):
    assert pii.personal_data(table(spark, [])).collect() == []


def plain_matches(text):
    """Ranges from one bigram of a template to another, all of them tried."""
    words = re.sub("[^a-z0-9]+", " ", "".join(c.lower() if c.isascii() else c for c in text or "")).split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = []
    for number, (licence, template) in enumerate(licenses.TEMPLATES):
        held = Counter(licenses.bigrams(template))
        size = sum(held.values())
        hits = [i for i, p in enumerate(pairs) if p in held]
        for start in hits:
            best, bag = None, Counter()
            for i in hits:
                if i < start or i - start + 1 > licenses.HIGH * size + 1e-9:
                    continue
                bag[pairs[i]] += 1
                common = sum(min(n, held[p]) for p, n in bag.items())
                dice = 2.0 * common / (i - start + 1 + size)
                if dice >= licenses.LEAST and (best is None or dice > best[0]):
                    best = (dice, i)
            if best:
                found.append((best[0], best[1] - start, -start, -number, licence, start, best[1]))
    return [
        f for f in found
        if not any(o[5] <= f[6] and o[6] >= f[5] and o[:4] > f[:4] for o in found)
    ]


def plain_scan(rows):
    out = {}
    for doc_id, text in rows:
        for dice, *_, licence, _, _ in plain_matches(text):
            notices, most = out.get((doc_id, licence), (0, 0.0))
            out[doc_id, licence] = (notices + 1, max(most, dice))
    return out


def scanned(spark, rows):
    found = licenses.scan(table(spark, rows, extra=True)).collect()
    return {(r["doc_id"], r["licence"]): (r["notices"], r["dice"]) for r in found}


def damaged(text, share, seed):
    """Some words replaced, dropped or added."""
    rng, words = random.Random(seed), text.split()
    for _ in range(max(1, int(len(words) * share))):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([["thing"], [], [words[at], "and"]])
    return " ".join(words)


def test_licences(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, f"{prose(1, 20)}\n  {notice.upper()} \n{prose(2, 20)}\nReleased under the MIT License."),
        (2, "licensed under the apache license"),  # too short
        (3, prose(3, 100)),
        (4, notice.replace(" ", "\n", 3)),
        (5, "\n\n" + notice + "\n" + notice),
        (6, f"Foo is a tool. {notice} See the manual. All rights reserved by Foo."),
        *[(10 + i, t) for i, (_, t) in enumerate(awkward())],
    ]
    got = scanned(spark, rows)
    assert got == plain_scan(rows)
    assert got[1, "apache-2.0"] == (1, 1.0) and got[1, "mit"] == (1, 1.0)
    assert got[4, "apache-2.0"] == (1, 1.0)
    assert got[5, "apache-2.0"] == (2, 1.0)
    assert got[6, "apache-2.0"] == got[6, "proprietary"] == (1, 1.0)
    assert {d for d, _ in got} <= {1, 2, 4, 5, 6}
    assert licenses.scan(table(spark, [])).collect() == []


def test_damaged_licences_in_running_text(spark):
    """Every template, whole and damaged, amid a line, wrapped, and without any line break."""
    rows, some = [], 0
    for k, (licence, text) in enumerate(licenses.TEMPLATES):
        for j, share in enumerate((0.0, 0.05, 0.1)):
            bad = damaged(text, share, 100 * k + j) if share else text
            wrapped = re.sub(r"((?:\S+ ){7})", r"\1\n * ", bad)
            body = wrapped if j % 2 else bad
            rows.append((10 * k + j, f"{prose(k, 15)} {body} {prose(50 + k, 15)}"))
    rows.append((5000, " ".join(t for _, t in licenses.TEMPLATES)))  # all, side by side
    rows.append((5001, "All rights reserved. " * 400))
    rows.append((5002, "Released under the MIT License.\n" * 300))
    got = scanned(spark, rows)
    assert got == plain_scan(rows)
    for k, (licence, text) in enumerate(licenses.TEMPLATES):
        assert got[10 * k, licence] == (1, 1.0)
        some += sum(0.8 <= got.get((10 * k + j, licence), (0, 0))[1] < 1 for j in (1, 2))
    assert some > 30
    assert got[5001, "proprietary"] == (400, 1.0)


def test_every_match_holds_a_telling_word():
    single, together = licenses.telling_words()
    rng = random.Random(3)
    for _, text in licenses.TEMPLATES:
        pairs = licenses.bigrams(text)
        for _ in range(300):
            chosen = rng.sample(pairs, licenses.least_common(len(pairs)))
            words = {w for p in chosen for w in p.split()}
            assert words & set(single) or any(words >= set(t) for t in together)


def test_dice_bound_is_the_coefficients():
    """No bag pair outside the size bounds reaches the least coefficient."""
    low, high = licenses.LEAST / (2 - licenses.LEAST), (2 - licenses.LEAST) / licenses.LEAST
    for a in range(1, 60):
        for b in range(1, 60):
            if not low * b - 1e-9 <= a <= high * b + 1e-9:
                assert 2 * min(a, b) / (a + b) < licenses.LEAST

"""Conversation repair against a search over whole audits."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.corpus import FOLDER
from tidemark.llm import conversations as C
from tidemark.llm.queries import QUERIES

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
WHITE = " \t\n\x0b\x0c\r"
STATES = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def after_damage(rows):
    """Conversations as lists of (turn, role, text), sorted, all conversations included."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fate = zlib.crc32(key.encode()) % 20
        out[conv_id]
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        out[conv_id] += [(turn, role, text)] * (2 if fate == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit) by whole strings: every state keeps its best, with whole audits."""
    at = {"": (0, "", ())}

    def inserted(at):
        for _ in range(4):
            for state, (cost, audit, said) in list(at.items()):
                for letter, then in STATES[state].items():
                    if letter != "s":
                        option = (cost + 2, audit + "I", said + ((C.NAMES[letter], ""),))
                        if then not in at or option[:2] < at[then][:2]:
                            at[then] = option
        return at

    at = inserted(at)
    for (_, role, text), fault in zip(rows, found):
        new = {}

        def offer(state, option):
            if state not in new or option[:2] < new[state][:2]:
                new[state] = option

        for state, (cost, audit, said) in at.items():
            offer(state, (cost + 3, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            more = 1 if fault == "truncated" else 0
            for letter, then in STATES[state].items():
                if role[:1] == letter:
                    offer(then, (cost + more, audit + "K", said + ((role, text),)))
                if letter != "s":
                    offer(then, (cost + 2 + more, audit + "R", said + ((C.NAMES[letter], text),)))
        at = inserted(new)
    return min((at[s] for s in ("", "a") if s in at), key=lambda x: x[:2])


def expected(rows):
    out = []
    for conv_id, found in after_damage(rows).items():
        kinds = faults(found)
        turns = {t for t, _, _ in found if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, said = cheapest(found, kinds)
        text = "\n".join(f"{r}:{t}" for r, t in said)
        out.append(
            (conv_id, gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")])
            + (illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
        )
    return Counter(out)


def found(df):
    return Counter(tuple(r)[:-1] for r in C.repair(df).collect())


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("fault", "again", "dropped", "step", "edit", "copies") if extra else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def drawn(seed, conversations, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ux"]
    texts = ["Yes.", "No", "go on!", " ", "", None, "why? ", "a\nb", "ok .\n", "été…"]
    rows = []
    for conv_id in range(conversations):
        turn = 0
        for _ in range(rng.randint(1, most)):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            rows.append(
                (conv_id, turn if rng.random() > 0.03 else None, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"line {rng.random()}.")
            )
    return rows


@pytest.mark.parametrize("seed,most", [(1, 6), (2, 12), (3, 60)])
def test_repairs_like_a_search_over_whole_audits(spark, seed, most):
    rows = drawn(seed, 300, most)
    assert found(table(spark, rows, extra=True).repartition(7)) == expected(rows)


def test_table_like_a_search_over_whole_audits(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(tuple(r)[:-1] for r in QUERIES["op11_conversation_repair"](spark, FOLDER).collect()) == expected(rows)


def test_nulls_empty_and_long_texts_and_repeated_rows(spark):
    long = "word " * 60_000
    rows = [
        (None, None, None, None),
        (None, 1, "user", long),
        (None, 1, "user", long),
        (7, None, "assistant", long + "."),
        (7, 5, "system", "Be kind."),
        (7, 9, "user", "Hi."),
        (8, -3, "user", ""),
    ]
    assert found(table(spark, rows)) == expected(rows)
    assert found(table(spark, [])) == Counter()


def test_a_conversation_without_rows_left(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = C.repair(table(spark, [(dropped, 0, "user", "Hi.")])).first()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0)


def test_steps_are_the_digest_unfolded(spark):
    rows = table(spark, drawn(4, 200, 20))
    damaged = C.damaged(rows)
    audits = {r["conv_id"]: r for r in C.digests(damaged).collect()}
    by_conversation = defaultdict(list)
    for r in C.steps(damaged).collect():
        by_conversation[r["conv_id"]].append(r)
    assert set(by_conversation) <= set(audits)
    for conv_id, digest in audits.items():
        steps = sorted(by_conversation[conv_id], key=lambda r: r["step"])
        assert "".join(r["edit"] for r in steps) == digest["audit"]
        text = "\n".join(f"{r['role']}:{r['text']}" for r in steps if r["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == digest["repaired_sha256"]


def test_a_long_conversation_holds_few_undecided_edits():
    repair, told = C.Repair(), 0
    rng = random.Random(5)
    for i in range(20_000):
        told += len(repair.push(rng.choice("uauas"), rng.choice([None, None, C.BLANK, C.TRUNCATED])))
    assert repair.most < 200 and told > 19_000


def test_undecided_rows_wait_for_the_end():
    """Two chains of equal cost that only the end decides."""
    rows = [(None, "x", "t.")] * 9
    kinds = [None] * 9
    repair, out = C.Repair(), []
    for _ in rows:
        out += repair.push("x", None)
    cost, rest = repair.finish()
    assert (cost, "".join(e for e, _ in out + rest)) == cheapest(rows, kinds)[:2]

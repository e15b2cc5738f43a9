"""Structure repair of conversations: the cheapest edits, decided while rows stream by."""

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, map_batches

# --- Fixed values: the contract's damage, costs and edit names ---
DAMAGE_EVERY = 20
DROP, EMPTY, UNSTOP, REPEAT, AS_USER = range(5)
ENDS = r"[.!?]"
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
LEGAL_PAIRS = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}
# --- End of fixed values ---

#: What has been said so far: nothing, the system's line, the user last, the assistant last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)

STEPS = (
    "conv_id bigint, step bigint, edit string, turn bigint, fault string, role string, text string"
)
DIGESTS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string, most_unresolved bigint"
)


class Node:
    """An edit on some survivor's path; ``refs`` counts its children and survivors."""

    __slots__ = ("above", "edit", "letter", "depth", "refs")

    def __init__(self, above: "Node | None", edit: str, letter: str):
        self.above, self.edit, self.letter, self.refs = above, edit, letter, 0
        self.depth = above.depth + 1 if above else 0
        if above:
            above.refs += 1


def release(node: Node | None) -> None:
    """One reference less; edits that nobody refers to any more go."""
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        node = node.above


def precedes(a: tuple, b: tuple) -> bool:
    """Whether path ``a`` (node, further edits) is less than ``b`` in ASCII order.

    Both are compared from the last edit that they share, over all that is unresolved.
    """
    (x, more_a), (y, more_b) = a, b
    left, right = [more_a], [more_b]
    while x is not y:
        if x.depth >= y.depth:
            left.append(x.edit)
            x = x.above
        else:
            right.append(y.edit)
            y = y.above
    return "".join(reversed(left)) < "".join(reversed(right))


class Repair:
    """Viterbi over one conversation's rows; edits come out as soon as they are certain.

    Each state keeps its cheapest path, the ASCII-least of tied ones, as a leaf of a tree of
    backpointers. Where all survivors descend from one edit, everything above is decided and
    leaves the tree, so memory holds unresolved rows only. No tied path is a prefix of another:
    both have treated the same rows, and one more insertion costs more.

    A survivor that another one beats whatever follows is dropped: from after the assistant all
    that can follow the system's line can follow too, and a kept system line costs three at most
    to delete instead.
    """

    def __init__(self):
        self.root = Node(None, "", "")
        self.root.refs = 1
        self.at = {NOTHING: (0, self.root)}
        self.most = 0
        self._insert()

    def _replace(self, found: dict) -> None:
        """Survivors as (cost, parent, edit, letter) become leaves; the old ones are let go."""
        old = list(self.at.values())
        new = {}
        for state, (cost, above, edit, letter) in found.items():
            leaf = Node(above, edit, letter)
            leaf.refs += 1
            new[state] = (cost, leaf)
        for _, node in old:
            release(node)
        self.at = new

    def _insert(self) -> None:
        """Insertions, until none makes a state cheaper."""
        changed = True
        while changed:
            changed = False
            for state, (cost, node) in list(self.at.items()):
                for letter, then in NEXT[state].items():
                    if letter == "s":
                        continue
                    price, known = cost + INSERT_COST, self.at.get(then)
                    if known and (
                        price > known[0]
                        or price == known[0] and not precedes((node, INSERT), (known[1], ""))
                    ):
                        continue
                    leaf = Node(node, INSERT, letter)
                    leaf.refs += 1
                    self.at[then] = (price, leaf)
                    if known:
                        release(known[1])
                    changed = True
        best = self.at.get(ASSISTANT)
        if best:
            for state, margin in ((NOTHING, DELETE_COST), (SYSTEM, 0)):
                if state in self.at and self.at[state][0] > best[0] + margin:
                    release(self.at.pop(state)[1])

    def push(self, initial: str, fault: str | None) -> list[tuple[str, str]]:
        """Treat a row; the edits, with the letters they bring about, that are now certain."""
        found: dict = {}

        def offer(state, cost, node, edit, letter):
            known = found.get(state)
            if known is None or cost < known[0] or (
                cost == known[0] and precedes((node, edit), (known[1], known[2]))
            ):
                found[state] = (cost, node, edit, letter)

        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, (cost, node) in self.at.items():
            offer(state, cost + DELETE_COST, node, DELETE, "")
            if fault in (BLANK, DUPLICATE):
                continue
            for letter, then in NEXT[state].items():
                if letter == initial:
                    offer(then, cost + extra, node, KEEP, letter)
                if letter != "s":
                    offer(then, cost + extra + REROLE_COST, node, REROLE, letter)
        self._replace(found)
        self._insert()
        return self._certain()

    def _certain(self) -> list[tuple[str, str]]:
        """Edits above which no survivor branches off."""
        self.most = max(self.most, max(n.depth for _, n in self.at.values()) - self.root.depth)
        if self.root.refs != 1 or any(n is self.root for _, n in self.at.values()):
            return []
        node, path = next(iter(self.at.values()))[1], []
        while node is not self.root:
            path.append(node)
            node = node.above
        held = {id(n) for _, n in self.at.values()}
        out = []
        while path and self.root.refs == 1 and id(self.root) not in held:
            self.root = path.pop()
            out.append((self.root.edit, self.root.letter))
            self.root.above = None
        return out

    def finish(self) -> tuple[int, list[tuple[str, str]]]:
        """Cost, and the edits not yet told, of the best path to a lawful end."""
        ends = [self.at[s] for s in (NOTHING, ASSISTANT) if s in self.at]
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or other[0] == best[0] and precedes((other[1], ""), (best[1], "")):
                best = other
        node, rest = best[1], []
        while node is not self.root:
            rest.append((node.edit, node.letter))
            node = node.above
        return best[0], rest[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: ``conv_id``, ``turn``, ``role``, ``text``, ``dropped``.

    Null role and text are one space, and null ids count as one space in the key. Dropped rows
    stay, marked, so that every conversation is still known.
    """

    def part(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % DAMAGE_EVERY
    text = part("text")
    return (
        conversations.select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            F.when(fate == AS_USER, F.lit("user")).otherwise(part("role")).alias("role"),
            F.when(fate == EMPTY, F.lit(""))
            .when(fate == UNSTOP, F.regexp_replace(text, ENDS, ""))
            .otherwise(text)
            .alias("text"),
            (fate == DROP).alias("dropped"),
            F.when(fate == REPEAT, 2).otherwise(1).alias("copies"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .drop("copies", "copy")
    )


def untouched(conversations: DataFrame) -> DataFrame:
    """Rows for ``steps`` and ``digests`` as they are: null role and text are one space."""
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(False).alias("dropped"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of a conversation side by side, by turn (null first), role and text, with faults.

    One shuffle, by conversation; copies are numbered inside the same partitions, where the
    window's sort and the final one spill to disk. What was said before is thus known without
    a set of all texts in memory.
    """
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy("turn")
    again = F.row_number().over(same) > 1
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){SPACES}*\z", 1)
    return (
        rows.withColumn(
            "fault",
            F.when(last == "", F.lit(BLANK)).when(~last.rlike(ENDS), F.lit(TRUNCATED)),
        )
        .repartition("conv_id")
        .withColumn("again", again)
        .withColumn(
            "fault",
            F.when(F.col("fault") == BLANK, F.lit(BLANK))
            .when(F.col("again"), F.lit(DUPLICATE))
            .otherwise(F.col("fault")),
        )
        .sortWithinPartitions("conv_id", "turn", "role", "text", "again")
        .select("conv_id", "turn", "role", "text", "fault", "dropped")
    )


class Digest:
    """Counts of one conversation's rows, and the hash of its repaired ones."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns = [None, None, 0]  # first, last, distinct
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal, self.before = 0, None
        self.audit, self.hash, self.said = [], hashlib.sha256(), 0

    def row(self, turn, initial, fault) -> None:
        first, last, distinct = self.turns
        if turn is not None and turn != last:
            self.turns = [turn if first is None else first, turn, distinct + 1]
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.before = initial

    def edit(self, edit, role, text) -> None:
        self.audit.append(edit)
        if edit != DELETE:
            self.hash.update(f"{chr(10) if self.said else ''}{role}:{text}".encode())
            self.said += 1

    @property
    def gaps(self) -> int:
        first, last, distinct = self.turns
        return 0 if first is None else last - first + 1 - distinct


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Edits of the conversations in a sorted partition, as they become certain.

    Yields (Digest, edit, row, role, text) per edit, ``row`` being None for an insertion, and
    (Digest, None, cost, most unresolved, None) at the end of each conversation.
    """
    digest, repair, waiting = None, None, deque()

    def told(edits):
        for edit, letter in edits:
            if edit == INSERT:
                row, role, text = None, NAMES[letter], ""
            else:
                row = waiting.popleft()
                role, text = NAMES[letter] if edit == REROLE else row[1], row[2]
            digest.edit(edit, role, text)
            yield digest, edit, row, role, text

    def ended():
        cost, rest = repair.finish()
        yield from told(rest)
        yield digest, None, cost, repair.most, None

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv_id, turn, role, text, fault, dropped in zip(*columns):
            if digest is None or conv_id != digest.conv_id:
                if digest is not None:
                    yield from ended()
                digest, repair = Digest(conv_id), Repair()
                waiting.clear()
            if dropped:
                continue
            digest.row(turn, role[:1], fault)
            waiting.append((turn, role, text, fault))
            yield from told(repair.push(role[:1], fault))
    if digest is not None:
        yield from ended()


ROWS_OUT = 2000  # rows that a task hands back at once


def _columns(rows: list[tuple], names: list[str]) -> dict:
    return dict(zip(names, map(list, zip(*rows))))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def steps(rows: DataFrame) -> DataFrame:
    """The repaired conversations: an edit per row, deleted rows included.

    ``step`` counts a conversation's edits from 0; ``edit`` is K, R, D or I; ``role`` and
    ``text`` are those after the edit, of a deleted row its own; an insertion has neither
    ``turn`` nor ``fault``. Rows as from ``damaged`` or ``untouched``.

    Edits cost 0 to keep, 2 to give the user's or assistant's role, 3 to delete (a must for
    blank rows and repeats of an earlier role and text), 2 to insert; a row without a full stop
    costs 1 if it stays. The cheapest edits after which the roles' initials are
    ``(s?(ua)+)?`` are taken, of tied ones those whose letters come first in ASCII. Rows with
    equal turns go by role and text. All rows without a conversation id are one conversation.
    Texts of any length and empty tables are fine; other columns are not read.
    """
    names = _names(STEPS)

    def run(batches):
        out, of, step = [], None, 0
        for digest, edit, row, role, text in _conversations(batches):
            if digest is not of:
                of, step = digest, 0
            if edit is None:
                continue
            turn, fault = (row[0], row[3]) if row else (None, None)
            out.append((digest.conv_id, step, edit, turn, fault, role, text))
            step += 1
            if len(out) >= ROWS_OUT:
                yield _columns(out, names)
                out = []
        if out:
            yield _columns(out, names)

    return map_batches(_ordered(rows), run, STEPS)


def digests(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, and what ``steps`` would do to it.

    ``gaps`` (missing turns), ``blank``, ``duplicate``, ``truncated`` (each row's first fault),
    ``illegal`` (neighbouring initials beside su, ua, au), ``cost``, ``audit`` (the edits'
    letters) and ``repaired_sha256`` (``role:text`` lines). ``most_unresolved`` is the longest
    undecided tail in edits. The hash runs over a conversation's rows in order, so one task
    streams them; it holds undecided rows and the audit. A conversation all of whose rows were
    dropped has zeros, an empty audit and the hash of nothing.
    """
    names = _names(DIGESTS)

    def run(batches):
        out = []
        for digest, edit, cost, most, _ in _conversations(batches):
            if edit is None:
                counts = [digest.faults[f] for f in (BLANK, DUPLICATE, TRUNCATED)]
                hashed = digest.hash.hexdigest()
                out.append(
                    (digest.conv_id, digest.gaps, *counts, digest.illegal, cost)
                    + ("".join(digest.audit), hashed, most)
                )
                if len(out) >= ROWS_OUT:
                    yield _columns(out, names)
                    out = []
        if out:
            yield _columns(out, names)

    return map_batches(_ordered(rows), run, DIGESTS)


def repair(conversations: DataFrame) -> DataFrame:
    """Digests of the conversations after the contract's damage."""
    return digests(damaged(conversations))

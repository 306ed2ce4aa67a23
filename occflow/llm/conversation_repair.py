"""Conversation structure repair by a Viterbi search that emits edits as survivors coalesce.

A conversation should be an optional system turn and then pairs of user and assistant
turns, or be empty. Rows are kept, given another role or deleted, and empty turns are
inserted, at the least total cost; of equally cheap edits the ASCII-least row of
initials counts. Rows run through four states (nothing yet, after the system turn,
after a user turn, after a reply). Each state has one survivor, the best way there; its
edits are a path in a tree of back pointers. A node counts its children and the
survivors that stand on it. What no survivor can reach is dropped, and as soon as all
survivors share an ancestor the edits above it are final and are emitted, with their
texts. So a conversation of any length streams through a task that holds the
unresolved part only. Ties compare the whole unresolved parts of both paths: how two
survivors compare is carried along row by row, since two edits that differ stay
different. The first two states end when a later one is strictly cheaper even after it
deletes a system turn, so that they don't hold the tree open.

Blank, repeated and cut-off turns are found by Spark. Repeats come from the least turn
of each role and text in a conversation, combined on the map side; where a later one
stands travels as a short row of its own. Texts are shuffled once, sorted by
conversation and turn, and read in that order. All of a conversation passes through
one task, one row after another, since the digest of its repaired text is defined over
all of it; nothing but its edits' initials is collected there.

Defined results: null roles and texts count as one space. Rows go by turn, null first,
then by role and text; rows equal in these are repeats of the first. A null
conversation id is a conversation. A conversation whose rows were all dropped is still
reported, with zeros. Other columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.staging import Stage

# Characters after which a task sends on what it has made.
SLICE = 1 << 22

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

START, SYSTEM, USER, REPLY = range(4)
# The role that a row must have to follow each state, and the state after it. A system
# turn may also be kept at the start.
NEXT = {START: "user", SYSTEM: "user", USER: "assistant", REPLY: "user"}
AFTER = {"user": USER, "assistant": REPLY}
INITIALS = {"u": USER, "a": REPLY, "s": SYSTEM}
LEGAL = ("su", "ua", "au")
SPACES = r"\x20\x09-\x0D"


# Rows of a conversation's stream, in this order within a turn.
ABSENT, REPEAT, TURN = range(3)


class Node:
    """One edit of a path; ``refs`` counts its children, and one more if a survivor ends here."""

    __slots__ = ("letter", "parent", "refs", "row")

    def __init__(self, parent: Node | None, letter: str, row: tuple | None) -> None:
        self.parent, self.letter, self.row, self.refs = parent, letter, row, 0
        if parent is not None:
            parent.refs += 1


@dataclass(frozen=True)
class Way:
    """A way into a state: a survivor of the row before, and the edits since."""

    cost: int
    base: int
    edits: str


# How the edits of one survivor compare with those of another.
LESS, GREATER, BEGINS, EXTENDS = range(4)
_TURNED = (GREATER, LESS, EXTENDS, BEGINS)


class Search:
    """The survivors of one conversation. ``push`` and ``close`` return edits that are final, as (letter, row)."""

    def __init__(self) -> None:
        self._root = Node(None, "", None)
        self._root.refs = 1
        self._alive = {START: (0, self._root)}
        self._order: dict[tuple[int, int], int] = {}
        self.held = 1  # nodes in memory
        self._try_at = 8
        self._settle({START: Way(0, START, "")}, None)

    def push(self, initial: str, fault: int, row: tuple) -> list[tuple[str, tuple | None]]:
        """The next row, by its role's initial and its fault."""
        ways: dict[int, Way] = {}
        cut = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, (cost, _) in self._alive.items():
            self._offer(ways, state, Way(cost + DELETE_COST, state, DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            after = AFTER[NEXT[state]]
            if INITIALS.get(initial) == after:
                self._offer(ways, after, Way(cost + cut, state, KEEP))
            elif initial == "s" and state == START:
                self._offer(ways, SYSTEM, Way(cost + cut, state, KEEP))
            self._offer(ways, after, Way(cost + REROLE_COST + cut, state, REROLE))
        self._settle(ways, row)
        if self.held < self._try_at:
            return []
        out = self._shared(next(iter(self._alive.values()))[1])
        self._try_at = max(8, 2 * self.held)
        return out

    def close(self) -> tuple[int, list[tuple[str, tuple | None]]]:
        """The least cost, and the edits not returned yet."""
        ends = [s for s in (START, REPLY) if s in self._alive]
        best = min(ends, key=lambda s: self._alive[s][0])
        other = next((s for s in ends if s != best and self._alive[s][0] == self._alive[best][0]), None)
        if other is not None and self._relation(other, best) in (LESS, BEGINS):
            best = other
        cost, node = self._alive[best]
        path = []
        while node is not self._root:
            path.append((node.letter, node.row))
            node = node.parent
        return cost, path[::-1]

    def _relation(self, a: int, b: int) -> int:
        return self._order[a, b] if a < b else _TURNED[self._order[b, a]]

    def _compare(self, a: Way, b: Way) -> int:
        """How the whole unresolved edits of two ways compare."""
        if a.base == b.base:
            if b.edits.startswith(a.edits):
                return BEGINS
            return EXTENDS if a.edits.startswith(b.edits) else (LESS if a.edits < b.edits else GREATER)
        before = self._relation(a.base, b.base)
        # A survivor that begins another lacks its last inserts: the row's edit meets the first of these.
        if before == BEGINS:
            return LESS if a.edits[0] < INSERT else GREATER
        if before == EXTENDS:
            return GREATER if b.edits[0] < INSERT else LESS
        return before

    def _offer(self, ways: dict[int, Way], state: int, way: Way) -> None:
        held = ways.get(state)
        if held is None or way.cost < held.cost or (way.cost == held.cost and self._compare(way, held) in (LESS, BEGINS)):
            ways[state] = way

    def _settle(self, ways: dict[int, Way], row: tuple | None) -> None:
        """Insert turns after the row, drop what can't win, and make the ways left the survivors."""
        for to, origins in ((USER, (START, SYSTEM, REPLY)), (REPLY, (USER,))):
            for state in origins:
                if (way := ways.get(state)) is not None:
                    self._offer(ways, to, Way(way.cost + INSERT_COST, way.base, way.edits + INSERT))
        # From a reply on, all that may follow these two may follow too, but for a system turn.
        if SYSTEM in ways and ways[REPLY].cost < ways[SYSTEM].cost:
            del ways[SYSTEM]
        if START in ways and ways[REPLY].cost + DELETE_COST < ways[START].cost:
            del ways[START]
        states = sorted(ways)
        order = {(a, b): self._compare(ways[a], ways[b]) for k, a in enumerate(states) for b in states[k + 1 :]}
        made: dict[tuple[int, str], Node] = {}
        alive = {}
        for state in states:
            way = ways[state]
            node = self._alive[way.base][1]
            for k, letter in enumerate(way.edits):
                key = (way.base, way.edits[: k + 1])
                if key not in made:
                    made[key] = Node(node, letter, row if letter in (KEEP, REROLE) else None)
                    self.held += 1
                node = made[key]
            node.refs += 1
            alive[state] = (way.cost, node)
        for _, node in self._alive.values():
            self._release(node)
        self._alive, self._order = alive, order

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node is not self._root:
            self.held -= 1
            node = node.parent
            node.refs -= 1

    def _shared(self, survivor: Node) -> list[tuple[str, tuple | None]]:
        """Emit the edits that all survivors share."""
        path = []
        while survivor is not self._root:
            path.append(survivor)
            survivor = survivor.parent
        out = []
        while path and self._root.refs == 1:
            node = path.pop()
            out.append((node.letter, node.row))
            node.parent = None
            self._root = node
            self.held -= 1
        return out


@dataclass
class Report:
    """What is counted of one conversation."""

    conv_id: object
    rows: int = 0
    low: int | None = None
    high: int | None = None
    turns: int = 0
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    cost: int = 0

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)


class Walk:
    """Turns the final edits into (letter, role, text): role and text are those after repair, None if deleted."""

    def __init__(self) -> None:
        self._state = START

    def __call__(self, edits: Iterable[tuple[str, tuple | None]]) -> Iterator[tuple[str, str | None, str | None]]:
        for letter, row in edits:
            if letter == DELETE:
                yield letter, None, None
                continue
            role = row[0] if letter == KEEP else NEXT[self._state]
            self._state = INITIALS[role[:1]]
            yield letter, role, "" if letter == INSERT else row[1]


def events(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Report, list[tuple] | None]]:
    """From sorted rows: each conversation's report with edits that have become final, at its end with None."""
    report = search = walk = last = here_turn = None
    here: set[tuple[int, int]] = set()  # repeated role and text, of the turn that is read

    def end() -> Iterator[tuple[Report, list[tuple] | None]]:
        report.cost, rest = search.close()
        yield report, list(walk(rest))
        yield report, None

    for batch in batches:
        names = ("conv_id", "turn", "kind", "role", "text", "fault", "a", "b")
        for conv, turn, kind, role, text, fault, a, b in zip(*(batch.column(n).to_pylist() for n in names)):
            if report is None or conv != report.conv_id:
                if report is not None:
                    yield from end()
                report, search, walk, last = Report(conv), Search(), Walk(), None
                here.clear()
            if kind == ABSENT:
                continue
            if here_turn != turn:
                here.clear()
                here_turn = turn
            if kind == REPEAT:
                here.add((a, b))
                continue
            if fault != BLANK and ((a, b) in here or (last is not None and last[1:] == (turn, role, text))):
                fault = DUPLICATE
            initial = role[:1]
            if turn is not None:
                if report.low is None:
                    report.low = turn
                if report.high != turn:
                    report.high, report.turns = turn, report.turns + 1
            report.rows += 1
            report.faults[fault] += 1
            report.illegal += last is not None and last[0] + initial not in LEGAL
            last = (initial, turn, role, text)
            if final := search.push(initial, fault, (role, text)):
                yield report, list(walk(final))
    if report is not None:
        yield from end()


def stream(
    turns: DataFrame,
    stage: Stage,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    absent: Column | None = None,
) -> DataFrame:
    """Rows and marks of repeats, each conversation whole and in order within a partition.

    A row for which ``absent`` holds only tells that its conversation exists.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    gone = F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.when(~gone, F.col(turn).cast("long")).alias("turn"),
        F.when(gone, ABSENT).otherwise(TURN).alias("kind"),
        F.when(~gone, filled(role)).alias("role"),
        F.when(~gone, filled(text)).alias("text"),
    )
    blank = ~F.col("text").rlike(f"[^{SPACES}]")
    cut = ~F.col("text").rlike(rf"[.!?][{SPACES}]*\z")
    rows = rows.select(
        "*",
        F.when(blank, BLANK).when(cut, TRUNCATED).otherwise(0).alias("fault"),
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit(7), "role", "text").alias("b"),
    )
    places = rows.where((F.col("kind") == TURN) & (F.col("fault") != BLANK)).select(
        "conv_id", "a", "b", F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("at")
    )
    first = places.groupBy("conv_id", "a", "b").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    # Stored, so that its size is known and a hot key of the join can be split.
    first = stage.table(first.where(F.col("last") > F.col("first")).drop("last"), "repeated_turns").alias("first")
    same = F.col("p.conv_id").eqNullSafe(F.col("first.conv_id")) & (F.col("p.a") == F.col("first.a")) & (F.col("p.b") == F.col("first.b"))
    marks = places.alias("p").join(first, same).where(F.col("p.at") > F.col("first.first"))
    nothing = F.lit(None).cast("string")
    marks = marks.select(
        "p.conv_id", "p.at.turn", F.lit(REPEAT).alias("kind"), nothing.alias("role"), nothing.alias("text"), F.lit(0).alias("fault"), "p.a", "p.b"
    )
    ordered = ("conv_id", F.col("turn").asc_nulls_first(), "kind", "role", "text")
    return rows.unionByName(marks).repartition("conv_id").sortWithinPartitions(*ordered)


def repair(turns: DataFrame, stage: Stage, **columns) -> DataFrame:
    """conv_id, place (of the edit), edit, role and text (after repair; null if deleted), in order within a partition.

    ``columns`` are those of ``stream``.
    """
    rows = stream(turns, stage, **columns)
    names = ("conv_id", "place", "edit", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (id_type, pa.int64(), pa.string(), pa.string(), pa.string())
        held: list[tuple] = []
        size = place = 0
        for report, edits in events(batches):
            if edits is None:
                place = 0
                continue
            for letter, role, text in edits:
                held.append((report.conv_id, place, letter, role, text))
                place += 1
                size += len(text or "") + 16
            if size >= SLICE:
                yield _batch(held, kinds, names)
                held, size = [], 0
        if held:
            yield _batch(held, kinds, names)

    id_type = to_arrow_type(rows.schema["conv_id"].dataType)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit(turns: DataFrame, stage: Stage, **columns) -> DataFrame:
    """Per conversation: conv_id, the counts, audit (its edits' initials) and repaired_sha256 (of ``role:text`` lines)."""
    rows = stream(turns, stage, **columns)
    names = ("conv_id", *COUNTS, "audit", "repaired_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (id_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string())
        held: list[tuple] = []
        size, letters, digest, started = 0, [], hashlib.sha256(), False
        for report, edits in events(batches):
            if edits is not None:
                letters.append("".join(e[0] for e in edits))
                for _, role, text in edits:
                    if role is not None:
                        digest.update((f"\n{role}:{text}" if started else f"{role}:{text}").encode("utf-8", "surrogatepass"))
                        started = True
                continue
            counts = (report.gaps, *report.faults[1:], report.illegal, report.cost)
            held.append((report.conv_id, *counts, "".join(letters), digest.hexdigest()))
            size += len(held[-1][-2]) + 200
            letters, digest, started = [], hashlib.sha256(), False
            if size >= SLICE:
                yield _batch(held, kinds, names)
                held, size = [], 0
        if held:
            yield _batch(held, kinds, names)

    id_type = to_arrow_type(rows.schema["conv_id"].dataType)
    kind = rows.schema["conv_id"].dataType.simpleString()
    counted = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(run, f"conv_id {kind}, {counted}, audit string, repaired_sha256 string")


def _batch(rows: list[tuple], kinds: tuple, names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))

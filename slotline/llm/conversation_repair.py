"""Conversations of a legal structure, by shortest paths over a lattice of edits.

A conversation's rows are taken by turn (nulls first; rows of one turn by role, then text). Read as initials of its roles a
repaired conversation is empty, or an optional ``s`` and then ``ua`` once or more. Each row is kept (K, cost 0), given the
role user or assistant that fits (R, 3) or deleted (D, 4); messages of empty text may be inserted anywhere (I, 3). Blank
rows and rows whose role and text came before are deleted; a row that stays without a full stop at its end costs 3 more.

The lattice has a node for each row and each state of the pattern: nothing yet, after a system, a user or an assistant
message. Two searches by Dijkstra's rule run towards each other, one from the start and one from the ends, each with
its own heap. Once their least costs exceed the best sum found, all crossings of that sum are known. Of the audits (the
edits' initials) through them the least in ASCII order is taken: the forward search carries its least audit to a
node, and behind a crossing the least letter that stays on a shortest path is taken each time, as a state and a
letter leave one way only. An audit says all: what it does follows from the rows.

A conversation of up to ``PIECE`` rows and ``PIECE_BYTES`` is one task's small group. Longer ones, up to a third of all rows, are
never held together: equal rows shrink to a row with a count, first occurrences come from an aggregate, and
rows are sorted by ranges and cut into pieces, whose shortest paths are worked out from every state to every state. The
pieces of a conversation are then read in order, with the best cost, audit and hash for each state so far.
An audit and a hash of a whole conversation are one value and one pass by their nature; the repaired
messages come by piece (``repaired``).

Nulls: a role or text counts as one blank, a null turn comes first and counts for no gap, a null conv_id is a conversation.
Any other role than system, user and assistant (by initial) can't be kept. Texts of any length are read whole.
Repeated rows are duplicates. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from slotline.llm.common import small_batches, staged

PIECE = 512
PIECE_BYTES = 8 << 20
SPACE = r"\x20\x09-\x0D"

# A row's code: the class of its role's initial, and what must be or costs more.
CLASSES = {"s": 0, "u": 1, "a": 2}
OTHER, GONE, OPEN = 3, 4, 8
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
OPEN_COST = 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state after the next message that is not a system one.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Insertions that end a conversation, by state.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
Ways = dict[tuple[int, int], tuple[int, str]]


def _step(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Letter, next state and cost of each edit of a row of this code."""
    yield "D", state, DELETE
    if code & GONE:
        return
    more = OPEN_COST if code & OPEN else 0
    initial = code & 3
    if initial == 0 and state == START:
        yield "K", SYSTEM, KEEP + more
    elif (initial == 1 and state != USER) or (initial == 2 and state == USER):
        yield "K", TURN[state], KEEP + more
    yield "R", TURN[state], REROLE + more


_AHEAD = {code: {state: sorted(_step(code, state)) for state in STATES} for code in range(16)}
_BACK = {
    code: {to: [(state, cost) for state in STATES for _, end, cost in _AHEAD[code][state] if end == to] for to in STATES}
    for code in range(16)
}
_BEFORE = {to: [state for state in STATES if TURN[state] == to] for to in STATES}


def shortest(codes: bytes, start: int, ends: tuple[int, ...], trailing: bool = True) -> tuple[int, str] | None:
    """The least cost and audit from ``start`` to one of ``ends``, by two searches that meet.

    Without ``trailing`` nothing is inserted behind the last row.
    """
    last = len(codes)
    may_insert = last if trailing else last - 1
    goals = {(last, state) for state in ends}
    ahead: dict[tuple[int, int], tuple[int, str]] = {(0, start): (0, "")}
    back: dict[tuple[int, int], int] = dict.fromkeys(goals, 0)
    front = [(0, "", (0, start))]
    rear = [(0, goal) for goal in sorted(goals)]
    settled, closed = set(), set()
    best = 0 if (0, start) in goals else float("inf")
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, audit, node = heappop(front)
            if node in settled:
                continue
            settled.add(node)
            row, state = node
            near = [("I", (row, TURN[state]), INSERT)] if row <= may_insert else []
            if row < last:
                near += [(letter, (row + 1, to), more) for letter, to, more in _AHEAD[codes[row]][state]]
            for letter, other, more in near:
                label = (cost + more, audit + letter)
                if other not in settled and label < ahead.get(other, (float("inf"), "")):
                    ahead[other] = label
                    heappush(front, (*label, other))
                    if other in back:
                        best = min(best, label[0] + back[other])
        else:
            cost, node = heappop(rear)
            if node in closed:
                continue
            closed.add(node)
            row, state = node
            near = [((row, other), INSERT) for other in _BEFORE[state]] if row <= may_insert else []
            if row:
                near += [((row - 1, other), more) for other, more in _BACK[codes[row - 1]][state]]
            for other, more in near:
                if cost + more < back.get(other, float("inf")):
                    back[other] = cost + more
                    heappush(rear, (cost + more, other))
                    if other in ahead:
                        best = min(best, cost + more + ahead[other][0])
    if best == float("inf"):
        return None
    reach = rear[0][0] if rear else float("inf")

    def rest(node: tuple[int, int]) -> str:
        letters = []
        while not (back[node] == 0 and node in goals):
            row, state = node
            near = [("I", (row, TURN[state]), INSERT)] if row <= may_insert else []
            if row < last:
                near += [(letter, (row + 1, to), more) for letter, to, more in _AHEAD[codes[row]][state]]
            letter, node = min((x, other) for x, other, more in near if back.get(other, -1) + more == back[node] and other in back)
            letters.append(letter)
        return "".join(letters)

    # Each cheapest path leaves the nodes settled from the start at a crossing that the other search has settled.
    crossings = [
        (node, audit) for node, (cost, audit) in ahead.items()
        if node in back and cost + back[node] == best and (node in goals or (node not in settled and back[node] < reach))
    ]
    return best, min(audit + rest(node) for node, audit in crossings)


@lru_cache(maxsize=1 << 15)
def _known(codes: bytes) -> tuple[int, str]:
    return shortest(codes, START, (START, ASSISTANT))


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation; short ones are looked up again."""
    return _known(codes) if len(codes) <= 24 else shortest(codes, START, (START, ASSISTANT))


def edited(messages: list[tuple[str, str]], audit: str, state: int = START) -> list[tuple[str, str]]:
    """The messages after the audit's edits, from a state on."""
    out, rows = [], iter(messages)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        state = SYSTEM if letter == "K" and role.startswith("s") else TURN[state]
        out.append((role if letter == "K" else ROLES[state], text))
    return out


class Tally:
    """Counts of a run of rows of one conversation, in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_initial = self.last_initial = None
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, initial: str, blank: bool, again: bool, cut: bool) -> int:
        """Count a row; its code."""
        self.join(initial, initial, turn, turn, 0 if turn is None else 1, 0)
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut and not blank and not again
        return CLASSES.get(initial, OTHER) | (GONE if blank or again else OPEN if cut else 0)

    def join(self, first: str | None, last: str | None, low: int | None, high: int | None, turns: int, illegal: int) -> None:
        """Take in what follows: its first and last initials, turns, count of different turns and illegal neighbours."""
        if first is not None:
            if self.last_initial is not None:
                self.illegal += self.last_initial + first not in ("su", "ua", "au")
            else:
                self.first_initial = first
            self.last_initial = last
        self.illegal += illegal
        if low is not None:
            self.turns += turns - (self.last_turn == low)
            self.first_turn = low if self.first_turn is None else self.first_turn
            self.last_turn = high

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def _digest(messages: Iterable[tuple[str, str]], into, begun: bool) -> bool:
    for role, text in messages:
        into.update((("\n" if begun else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        begun = True
    return begun


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, with their faults: ``copies`` is 0 for a dropped row, 2 for a repeated one."""
    blank = F.lit(" ")
    shown = lambda name: F.coalesce(F.col(name).cast("string"), blank)
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = (
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return faulty(rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies")))


def faulty(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, copies) with ``initial``, ``blank`` and ``cut``."""
    return rows.select(
        "*", F.left("role", F.lit(1)).alias("initial"), (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"),
    )


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_MESSAGES = "messages array<struct<role:string,text:string>>"
_FIELDS = ["turn", "role", "text", "copies", "initial", "blank", "cut"]


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names))


def _same_key(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with an equal first value, which may be null."""
    for key, run in groupby(rows, lambda row: (row[0] is None, row[0])):
        yield key[1], run


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, kind.type) for x, kind in zip(columns, schema)], schema=schema)


def _chunked(rows: Iterable[tuple], schema: pa.Schema, weight: Callable[[tuple], int] = lambda row: 1, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= most:
            yield _table(held, schema)
            held, size = [], 0
    if held:
        yield _table(held, schema)


def _schema(frame: DataFrame, ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType([frame.schema["conv_id"], *StructType.fromDDL(ddl).fields]), prefers_large_types=False)


def _ddl(frame: DataFrame, ddl: str) -> str:
    return f"conv_id {frame.schema['conv_id'].dataType.simpleString()}, {ddl}"


def _short(rows: DataFrame, messages: bool) -> DataFrame:
    """The report of conversations that a task can hold, with their repaired messages if wanted."""
    ddl = f"{_REPORT}, {_MESSAGES}" if messages else _REPORT
    schema = _schema(rows, ddl)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for conversation, run in _same_key(_rows(batches, ["conv_id", *_FIELDS])):
                tally, seen, held, codes = Tally(), set(), [], bytearray()
                for _, turn, role, text, copies, initial, blank, cut in run:
                    for _ in range(copies):
                        codes.append(tally.add(turn, initial, blank, (role, text) in seen, cut))
                        seen.add((role, text))
                        held.append((role, text))
                cost, audit = cheapest(bytes(codes))
                repaired = edited(held, audit)
                digest = hashlib.sha256()
                _digest(repaired, digest, False)
                found = (conversation, tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost, audit, digest.hexdigest())
                yield (*found, [{"role": role, "text": text} for role, text in repaired]) if messages else found

        return _chunked(each(), schema, lambda row: 1 + sum(len(x["text"]) for x in row[-1]) // 1000 if messages else 1)

    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.mapInArrow(solve, _ddl(rows, ddl))


_WAYS = "ways array<struct<start:int,end:int,cost:long,audit:string>>"
_PIECE = (
    "task int, piece long, first_initial string, last_initial string, first_turn long, last_turn long, turns long, "
    f"illegal long, blank long, duplicate long, truncated long, {_WAYS}, {_MESSAGES}"
)


def _pieces(rows: DataFrame, piece: int, piece_bytes: int) -> DataFrame:
    """Pieces of long conversations in order, each with its ways from state to state and its messages."""
    equal = ["conv_id", "turn", "role", "text"]
    once = rows.filter("copies > 0").groupBy(*equal, "initial", "blank", "cut").agg(F.sum("copies").alias("copies"))
    once = staged(once.withColumn("digest", F.sha2("text", 256)), "equal-rows")
    first = once.groupBy(F.col("conv_id").alias("of"), F.col("role").alias("of_role"), F.col("digest").alias("of_digest")).agg(F.min(F.struct("turn")).alias("first"))
    here = F.equal_null("conv_id", "of") & (F.col("role") == F.col("of_role")) & (F.col("digest") == F.col("of_digest"))
    known = once.join(first, here).select("conv_id", *_FIELDS, (~F.equal_null("turn", "first.turn")).alias("again"))
    known = staged(known, "known-rows")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = _schema(rows, _PIECE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def each() -> Iterator[tuple]:
            for conversation, run in _same_key(_rows(batches, ["conv_id", *_FIELDS, "again"])):
                tally, held, codes, size, number = Tally(), [], bytearray(), 0, 0

                def done() -> tuple:
                    ways = [(start, end, *found) for start in STATES for end in STATES if (found := shortest(bytes(codes), start, (end,), trailing=False))]  # noqa: B023
                    return (
                        conversation, task, number, tally.first_initial, tally.last_initial, tally.first_turn, tally.last_turn, tally.turns,  # noqa: B023
                        tally.illegal, tally.blank, tally.duplicate, tally.truncated,  # noqa: B023
                        [dict(zip(("start", "end", "cost", "audit"), way)) for way in ways],
                        [{"role": role, "text": text} for role, text in held],  # noqa: B023
                    )

                for _, turn, role, text, copies, initial, blank, open_, again in run:
                    for copy in range(copies):
                        codes.append(tally.add(turn, initial, blank, again or copy > 0, open_))
                        held.append((role, text))
                        size += len(text)
                        if len(held) >= piece or size >= piece_bytes:
                            yield done()
                            tally, held, codes, size, number = Tally(), [], bytearray(), 0, number + 1
                if held:
                    yield done()

        return _chunked(each(), schema, most=1)

    placed = known.repartitionByRange(tasks, *equal).sortWithinPartitions(*equal)
    return staged(placed.mapInArrow(cut, _ddl(rows, _PIECE)), "pieces")


def _ordered(pieces: DataFrame) -> DataFrame:
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "task", "piece")


class _Path:
    """The best way so far to a state: cost, audit, hash and the pieces' states."""

    def __init__(self, cost: int = 0, audit: str = "", digest=None, begun: bool = False, states: tuple | None = None):
        self.cost, self.audit, self.digest, self.begun, self.states = cost, audit, digest or hashlib.sha256(), begun, states

    def key(self) -> tuple[int, str]:
        return self.cost, self.audit


def _advance(paths: dict[int, _Path], ways: Ways, messages: list[tuple[str, str]] | None) -> dict[int, _Path]:
    best: dict[int, tuple[tuple[int, str], int, str]] = {}
    for (start, end), (cost, audit) in ways.items():
        if start in paths:
            before = paths[start]
            key = (before.cost + cost, before.audit + audit)
            if end not in best or key < best[end][0]:
                best[end] = (key, start, audit)
    out = {}
    for end, (key, start, audit) in best.items():
        digest, begun = paths[start].digest.copy(), paths[start].begun
        if messages is not None:
            begun = _digest(edited(messages, audit, start), digest, begun)
        out[end] = _Path(*key, digest, begun, (paths[start].states, start, end))
    return out


def _finished(paths: dict[int, _Path]) -> _Path:
    """The best whole path, with the insertions that end it."""
    for state, path in paths.items():
        added = ENDING[state]
        path.begun = _digest(edited([], added, state), path.digest, path.begun)
        path.cost, path.audit = path.cost + INSERT * len(added), path.audit + added
        path.states = (path.states, state)
    return min(paths.values(), key=_Path.key)


def _long_report(pieces: DataFrame) -> DataFrame:
    schema = _schema(pieces, _REPORT)
    names = ["conv_id", "first_initial", "last_initial", "first_turn", "last_turn", "turns", "illegal", "blank", "duplicate", "truncated", "ways", "messages"]

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for conversation, run in _same_key(_rows(batches, names)):
                tally, paths = Tally(), {START: _Path()}
                for _, first, last, low, high, turns, illegal, blank, duplicate, truncated, ways, messages in run:
                    tally.join(first, last, low, high, turns, illegal)
                    tally.blank, tally.duplicate, tally.truncated = tally.blank + blank, tally.duplicate + duplicate, tally.truncated + truncated
                    known = {(way["start"], way["end"]): (way["cost"], way["audit"]) for way in ways}
                    paths = _advance(paths, known, [(x["role"], x["text"]) for x in messages])
                path = _finished(paths)
                yield (conversation, tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, path.cost, path.audit, path.digest.hexdigest())

        return _chunked(each(), schema, most=1)

    return _ordered(pieces).mapInArrow(follow, _ddl(pieces, _REPORT))


def _long_messages(pieces: DataFrame) -> DataFrame:
    """conv_id, part and the repaired messages of each piece."""
    choice = "task int, piece long, part long, start int, audit string, ending int"
    schema = _schema(pieces, choice)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for conversation, run in _same_key(_rows(batches, ["conv_id", "task", "piece", "ways"])):
                paths, places = {START: _Path()}, []
                for _, task, number, ways in run:
                    known = {(way["start"], way["end"]): (way["cost"], way["audit"]) for way in ways}
                    paths = _advance(paths, known, None)
                    places.append((task, number, {key: audit for key, (_, audit) in known.items()}))
                states, ending = _finished(paths).states
                for part in range(len(places) - 1, -1, -1):
                    task, number, audits = places[part]
                    states, start, end = states
                    yield (conversation, task, number, part, start, audits[start, end], ending if part == len(places) - 1 else None)

        return _chunked(each(), schema)

    chosen = _ordered(pieces.select("conv_id", "task", "piece", "ways")).mapInArrow(choose, _ddl(pieces, choice))
    chosen = chosen.select(F.col("conv_id").alias("of"), F.col("task").alias("of_task"), F.col("piece").alias("of_piece"), "part", "start", "audit", "ending")
    here = F.equal_null("conv_id", "of") & (F.col("task") == F.col("of_task")) & (F.col("piece") == F.col("of_piece"))
    out = _schema(pieces, f"part long, {_MESSAGES}")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for conversation, part, start, audit, ending, messages in _rows(batches, ["conv_id", "part", "start", "audit", "ending", "messages"]):
                found = edited([(x["role"], x["text"]) for x in messages], audit, start)
                found += edited([], ENDING[ending], ending) if ending is not None else []
                yield (conversation, part, [{"role": role, "text": text} for role, text in found])

        return _chunked(each(), out, most=1)

    return pieces.select("conv_id", "task", "piece", "messages").join(chosen, here).mapInArrow(apply, _ddl(pieces, f"part long, {_MESSAGES}"))


def _by_length(rows: DataFrame, piece: int, piece_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The rows of conversations that a task can hold, and those of longer ones."""
    small_batches(rows.sparkSession, 1000)
    size = rows.groupBy(F.col("conv_id").alias("of")).agg(F.sum("copies").alias("held"), F.sum(F.length("text") * F.greatest("copies", F.lit(1))).alias("bytes"))
    long = size.filter((F.col("held") > piece) | (F.col("bytes") > piece_bytes)).select("of")
    here = F.equal_null("conv_id", "of")
    return rows.join(long, here, "left_anti"), rows.join(long, here, "left_semi")


def report(rows: DataFrame, piece: int = PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Faults, cost, audit and the repaired text's hash of each conversation of ``rows`` (see ``faulty``)."""
    short, long = _by_length(rows, piece, piece_bytes)
    return _short(short, False).unionByName(_long_report(_pieces(long, piece, piece_bytes)))


def repaired(rows: DataFrame, piece: int = PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """conv_id, part and the repaired messages; a conversation that a task can hold is one part."""
    short, long = _by_length(rows, piece, piece_bytes)
    whole = _short(short, True).select("conv_id", F.lit(0).cast("long").alias("part"), "messages")
    return whole.unionByName(_long_messages(_pieces(long, piece, piece_bytes)))

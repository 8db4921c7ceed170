"""Repair of conversation structure by Hirschberg's divide and conquer.

A conversation should read: an optional system turn, then pairs of a user and an
assistant turn. Turns are kept, given another role, deleted, or preceded by
inserted empty turns, at the least total cost; among equally cheap repairs the
one whose edit letters come first in ASCII order is taken.

Four states say what the repaired text ends with: nothing, the system turn, a
user turn, an assistant turn. To find a best path through n turns in memory
proportional to n, the forward costs of the first half and the backward costs of
the second half are computed as vectors of four, they meet in the middle, the
best crossing is chosen, and both halves are solved the same way. Two paths that
have read the same turns end in the same state or differ in a letter, so the
forward vector carries each state's rank among the best paths beside its cost:
that decides between equally cheap crossings without keeping any path.

Turns are range-partitioned in order of conversation and turn, so a conversation
of any length is spread over tasks. One that lies within a task is solved there.
The others are cut into segments of bounded size. A segment is summed up by its
4 x 4 costs and ranks, the chain of these tables is solved by the same method,
and then every segment is solved between its two states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import staged

# What the repaired text ends with.
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
# The state after an inserted or renamed turn, and the letters that complete a conversation.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ENDING = ("", "II", "I", "")
DELETE_COST, INSERT_COST, RENAME_COST, TRUNCATED_COST = 3, 2, 2, 1
LEGAL_PAIRS = {"su", "ua", "au"}

# Faults of a turn; the first that holds counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
WHITE = " \t\n\x0b\x0c\r"
MUST_DELETE = 8

# A segment of a long conversation has at most so many turns and about so many characters.
SEGMENT_TURNS, SEGMENT_CHARS = 4096, 4_000_000

Table = tuple  # table[p][r]: None, or (cost, key) of the best way from state p to state r
Vector = tuple  # vector[r]: None, or (cost, rank) of the best path to state r


def table_of(kind: int) -> Table:
    """Ways to deal with one turn: kind is 2 * (place of its initial in "sua", else 3) + truncated, or MUST_DELETE.

    The key is the letters: insertions before the turn, then what becomes of it.
    """
    rows: list[list[tuple[int, str] | None]] = []
    for p in range(4):
        best: list[tuple[int, str] | None] = [None] * 4

        def offer(state: int, cost: int, letters: str) -> None:
            if best[state] is None or (cost, letters) < best[state]:
                best[state] = (cost, letters)

        state = p
        # A third insertion would lead to a state that one or none reaches.
        for inserted in range(3):
            cost, letters = INSERT_COST * inserted, "I" * inserted
            offer(state, cost + DELETE_COST, letters + "D")
            if kind != MUST_DELETE:
                initial, extra = kind // 2, TRUNCATED_COST * (kind % 2)
                fits = state == START if initial == 0 else initial != 3 and FOLLOWING[state] == initial + 1
                if fits:
                    offer(initial + 1, cost + extra, letters + "K")
                offer(FOLLOWING[state], cost + RENAME_COST + extra, letters + "R")
            state = FOLLOWING[state]
        rows.append(best)
    return tuple(tuple(r) for r in rows)


def forward(vector: Vector, table: Table) -> tuple[int, Vector]:
    """The vector after one more item, less its least cost, which comes first."""
    reached: list[tuple | None] = [None] * 4
    for p, way in enumerate(vector):
        for r in range(4):
            step = table[p][r] if way else None
            if step:
                path = (way[0] + step[0], way[1], step[1])
                if reached[r] is None or path < reached[r]:
                    reached[r] = path
    least = min(x[0] for x in reached if x)
    order = sorted(x[1:] for x in reached if x)
    return least, tuple(x and (x[0] - least, order.index(x[1:])) for x in reached)


def backward(costs: tuple, table: Table) -> tuple:
    """Costs from each state to the goal with one more item before, less the least of them."""
    found = [
        min((s[0] + c for s, c in zip(table[p], costs) if s and c is not None), default=None) for p in range(4)
    ]
    least = min((c for c in found if c is not None), default=0)
    return tuple(None if c is None else c - least for c in found)


class Turns:
    """The steps for turns, given by kind. The same vectors come again and again, so steps are kept, up to a bound."""

    KEPT = 1 << 14

    def __init__(self):
        self.tables = [table_of(k) for k in range(MUST_DELETE + 1)]
        self._ahead: dict = {}
        self._back: dict = {}

    def ahead(self, vector: Vector, kind: int) -> tuple[int, Vector]:
        found = self._ahead.get((vector, kind))
        if found is None:
            if len(self._ahead) >= self.KEPT:
                self._ahead.clear()
            found = self._ahead[vector, kind] = forward(vector, self.tables[kind])
        return found

    def back(self, costs: tuple, kind: int) -> tuple:
        found = self._back.get((costs, kind))
        if found is None:
            if len(self._back) >= self.KEPT:
                self._back.clear()
            found = self._back[costs, kind] = backward(costs, self.tables[kind])
        return found

    def states(self, kinds: bytes, entry: int, goal: int) -> list[int]:
        return crossings(kinds, entry, goal, self.ahead, self.back)

    def whole(self, kinds: bytes) -> list[int]:
        """The states of a whole conversation's best repair."""
        return self.states(kinds, START, last_state(run_forward(kinds, START, self.ahead)[1]))


def unit(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


def run_forward(items: Sequence, entry: int, step: Callable) -> tuple[int, Vector]:
    total, vector = 0, unit(entry)
    for item in items:
        more, vector = step(vector, item)
        total += more
    return total, vector


def crossings(items: Sequence, entry: int, goal: int, ahead: Callable, back: Callable) -> list[int]:
    """The states before, between and after the items, on the best path from ``entry`` to ``goal``."""
    states = [entry] * (len(items) + 1)
    states[len(items)] = goal
    todo = [(0, len(items))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        _, vector = run_forward(items[lo:mid], states[lo], ahead)
        costs: tuple = tuple(0 if s == states[hi] else None for s in range(4))
        for i in range(hi - 1, mid - 1, -1):
            costs = back(costs, items[i])
        meeting = [(v[0] + c, v[1], s) for s, (v, c) in enumerate(zip(vector, costs)) if v and c is not None]
        states[mid] = min(meeting)[2]
        todo += [(lo, mid), (mid, hi)]
    return states


def last_state(vector: Vector) -> int:
    """Where the best path to a complete conversation ends, before the turns added at the end."""
    return min((v[0] + INSERT_COST * len(ENDING[s]), v[1], s) for s, v in enumerate(vector) if v)[2]


def kind_of(role: str, fault: int) -> int:
    if fault in (BLANK, DUPLICATE):
        return MUST_DELETE
    return 2 * ("sua".index(role[0]) if role[:1] in ("s", "u", "a") else 3) + (fault == TRUNCATED)


def apply(steps: Turns, rows: list[tuple], states: list[int], last: bool) -> tuple[str, int, list[dict]]:
    """(letters, cost, repaired turns) of rows (role, text, fault) between the states before and after each."""
    letters, cost, out = [], 0, []

    def insert(state: int, number: int) -> int:
        for _ in range(number):
            state = FOLLOWING[state]
            out.append({"role": NAMES[state], "text": ""})
        return state

    for (role, text, fault), p, r in zip(rows, states, states[1:]):
        price, way = steps.tables[kind_of(role, fault)][p][r]
        cost += price
        letters.append(way)
        insert(p, len(way) - 1)
        if way[-1] != "D":
            out.append({"role": role if way[-1] == "K" else NAMES[r], "text": text})
    if last:
        way = ENDING[states[-1]]
        insert(states[-1], len(way))
        cost += INSERT_COST * len(way)
        letters.append(way)
    return "".join(letters), cost, out


def fault_of(role: str, text: str, seen: set) -> int:
    """The first fault of a turn, given the digests of the turns before, to which its own is added."""
    body = text.rstrip(WHITE)
    if not body:
        return BLANK
    own = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    if own in seen:
        return DUPLICATE
    seen.add(own)
    return SOUND if body[-1] in ".!?" else TRUNCATED


def figures(rows: list[tuple]) -> dict:
    """What a piece adds to its conversation's counts; rows are (turn, role, text, fault)."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    faults = [r[3] for r in rows]
    return {
        "turns_read": len(rows),
        "first_turn": min(turns, default=None), "last_turn": max(turns, default=None), "distinct_turns": len(set(turns)),
        "first_initial": initials[0] if rows else None, "last_initial": initials[-1] if rows else None,
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:])),
    }


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_PIECE = {
    "turns_read": pa.int64(), "first_turn": pa.int64(), "last_turn": pa.int64(), "distinct_turns": pa.int64(),
    "first_initial": pa.string(), "last_initial": pa.string(), "blank": pa.int64(), "duplicate": pa.int64(),
    "truncated": pa.int64(), "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "turns": pa.list_(_TURN),
}
_PIECE_SQL = ", ".join(
    f"{n} {'array<struct<role:string,text:string>>' if n == 'turns' else 'string' if t == pa.string() else 'bigint'}"
    for n, t in _PIECE.items()
)
# A turn of a conversation that is not yet solved.
_OPEN = {"place": pa.int32(), "turn": pa.int64(), "role": pa.string(), "text": pa.string(), "fault": pa.int32()}
_OPEN_SQL = "place int, turn bigint, role string, text string, fault int"


def _batch(rows: list[dict], types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in types.items()], list(types))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def solved(steps: Turns, rows: list[tuple], states: list[int], last: bool) -> dict:
    letters, cost, turns = apply(steps, [r[1:] for r in rows], states, last)
    return figures(rows) | {"cost": cost, "audit": letters, "turns": turns}


def kinds_of(rows: list[tuple]) -> bytes:
    return bytes(kind_of(r[1], r[3]) for r in rows)


def _first_pass(ordered: DataFrame, kind: T.DataType, segment_turns: int) -> DataFrame:
    """Solved conversations (open is false), and the turns of those that may go on in another task or segment.

    The first and the last conversation of a task are never known to be whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, segment = Turns(), TaskContext.get().partitionId() << 32
        out: list[dict] = []
        size, id_type = 0, None
        conv, buffer, chars, seen, whole = None, [], 0, set(), False

        def close(ends: bool) -> None:
            nonlocal segment, buffer, chars, seen, size
            if ends and whole:
                states = steps.whole(kinds_of(buffer))
                out.append({"conv": conv, "segment": segment, "open": False} | solved(steps, buffer, states, True))
            else:
                key = {"conv": conv, "segment": segment, "open": True}
                out.extend(key | dict(zip(_OPEN, (i, *r))) for i, r in enumerate(buffer))
                if not buffer:  # every turn is left out, but the conversation is reported
                    out.append(key)
            segment, size, buffer, chars, seen = segment + 1, size + chars, [], 0, set()

        begun = False
        for batch in batches:
            id_type = batch.schema.field("conv").type
            types = {"conv": id_type, "segment": pa.int64(), "open": pa.bool_()} | _OPEN | _PIECE
            cells = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "live")]
            for this, turn, role, text, live in zip(*cells, strict=True):
                if not begun or this != conv:
                    if begun:
                        close(True)
                    conv, whole, begun = this, begun, True
                elif len(buffer) >= segment_turns or chars >= SEGMENT_CHARS:
                    whole = False
                    close(False)
                if live:
                    buffer.append((turn, role, text, fault_of(role, text, seen)))
                    chars += len(text)
            if size > 1 << 20 or len(out) > 1 << 14:
                yield _batch(out, types)
                out, size = [], 0
        if begun:
            whole = False
            close(True)
        if out:
            yield _batch(out, types)

    schema = f"conv {kind.simpleString()}, segment bigint, open boolean, {_OPEN_SQL}, {_PIECE_SQL}"
    return staged(ordered.mapInArrow(run, schema), "conversations")


def _segments(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Groups of rows with equal keys, which follow each other."""
    group, rows = None, []
    for row in _rows(batches):
        key = tuple(row[k] for k in keys)
        if group is not None and key != group:
            yield group, rows
            rows = []
        group = key
        rows.append(row)
    if group is not None:
        yield group, rows


def _grouped(df: DataFrame, by: str, *order: str) -> DataFrame:
    return df.repartition(F.col(by)).sortWithinPartitions(by, *order)


def _long(opened: DataFrame, kind: T.DataType) -> DataFrame:
    """Pieces of the conversations that were not solved in the first pass."""
    name = kind.simpleString()
    # A turn of an earlier segment makes this one a repetition. Each segment has a
    # digest once, so a group has no more rows than its conversation has segments.
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    first_use = F.coalesce(F.col("fault").isin(SOUND, TRUNCATED), F.lit(False))
    uses = Window.partitionBy("conv", "digest").orderBy("segment")
    # Rows that cannot be a first use get a group each.
    own = F.when(first_use, digest).otherwise(F.concat_ws("-", "segment", "place"))
    narrow = opened.select("conv", "segment", "place", "fault", F.substring("role", 1, 1).alias("role"), own.alias("digest"))
    late = (F.row_number().over(uses) > 1) & first_use
    narrow = narrow.withColumn("late", late).drop("digest")
    marked = staged(
        narrow.withColumn("fault", F.when(F.col("late"), F.lit(DUPLICATE)).otherwise(F.col("fault"))), "turns"
    )

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, out, id_type = Turns(), [], None

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("conv").type
                yield batch

        for (segment,), rows in _segments(watched(), ("segment",)):
            kinds = bytes(kind_of(r["role"], r["fault"]) for r in rows if r["place"] is not None)
            cells: list[int | None] = []
            for entry in range(4):
                total, vector = run_forward(kinds, entry, steps.ahead)
                cells += [c for v in vector for c in ((total + v[0], v[1]) if v else (None, None))]
            out.append({"conv": rows[0]["conv"], "segment": segment, "ways": cells})
        if out:
            yield _batch(out, {"conv": id_type, "segment": pa.int64(), "ways": pa.list_(pa.int64())})

    ways = _grouped(marked.select("conv", "segment", "place", "role", "fault"), "segment", "place").mapInArrow(
        sum_up, f"conv {name}, segment bigint, ways array<bigint>"
    )

    def solve_chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, rows in _segments(batches, ("conv",)):
            tables = []
            for row in rows:
                w = row["ways"]
                pairs = [None if w[i] is None else (w[i], w[i + 1]) for i in range(0, 32, 2)]
                tables.append(tuple(tuple(pairs[4 * p : 4 * p + 4]) for p in range(4)))
            states = crossings(tables, START, last_state(run_forward(tables, START, forward)[1]), forward, backward)
            for i, row in enumerate(rows):
                out.append({
                    "segment": row["segment"], "entry": states[i], "goal": states[i + 1], "final": i + 1 == len(rows),
                })
        if out:
            yield _batch(out, {"segment": pa.int64(), "entry": pa.int32(), "goal": pa.int32(), "final": pa.bool_()})

    ends = _grouped(ways, "conv", "segment").mapInArrow(
        solve_chain, "segment bigint, entry int, goal int, final boolean"
    )
    # For each segment its two states, its late repetitions and its turns, in this order.
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "bigint"), ("role", "string"), ("text", "string"))]
    none = F.lit(None).cast("int")
    records = opened.select(
        "conv", "segment", F.lit(2).alias("record"), "place", "turn", "role", "text", "fault",
        none.alias("entry"), none.alias("goal"), F.lit(None).cast("boolean").alias("final"),
    )
    records = records.unionByName(
        marked.where("late").select("segment", F.lit(1).alias("record"), "place"), allowMissingColumns=True
    ).unionByName(ends.select("segment", F.lit(0).alias("record"), "entry", "goal", "final", *empty), allowMissingColumns=True)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, types = Turns(), None

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal types
            for batch in batches:
                types = {"conv": batch.schema.field("conv").type, "segment": pa.int64()} | _PIECE
                yield batch

        for (segment,), rows in _segments(watched(), ("segment",)):
            ends = rows[0]
            late = {r["place"] for r in rows if r["record"] == 1}
            turns = [r for r in rows if r["record"] == 2]
            body = [
                (r["turn"], r["role"], r["text"], DUPLICATE if r["place"] in late else r["fault"])
                for r in turns if r["place"] is not None
            ]
            states = steps.states(kinds_of(body), ends["entry"], ends["goal"])
            piece = solved(steps, body, states, ends["final"])
            yield _batch([{"conv": turns[0]["conv"], "segment": segment} | piece], types)

    dealt = _grouped(records, "segment", "record", "place")
    return dealt.mapInArrow(solve, f"conv {name}, segment bigint, {_PIECE_SQL}")


def repair(
    turns: DataFrame,
    present: Column | None = None,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment_turns: int = SEGMENT_TURNS,
) -> DataFrame:
    """Pieces of the repaired conversations: (id_col, segment, whole, counts, cost, audit, turns).

    ``turns`` are the repaired turns, ``audit`` the letters of the edits: K kept,
    R role changed, D deleted, I inserted. A long conversation has several pieces
    in order of ``segment``; ``whole`` marks the only piece of a conversation. Rows
    for which ``present`` is false are left out, but their conversation is listed.
    Turns are read in order of their number (null first), then role and text.
    Null roles and texts are one space, so their turns are blank; rows without an
    id are one conversation; repeated rows count each. An empty table gives no
    rows. Other columns are not read, whatever their names.
    """
    space = F.lit(" ")
    rows = turns.select(
        F.col(id_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), space).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("live"),
        # Equal rows are told apart by their place, so they spread over ranges too.
        F.monotonically_increasing_id().alias("tie"),
    )
    # A digest stands for the text: the sampled bounds of the ranges stay short.
    rows = rows.withColumn("mark", F.xxhash64("text"))
    order = ["conv", "turn", "role", "mark", "tie"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("mark", "tie")
    kind = turns.schema[id_col].dataType
    found = _first_pass(ordered, kind, segment_turns)
    columns = ["conv", "segment", *_PIECE]
    done = found.where("NOT open").select(*columns)
    long = _long(found.where("open").select("conv", "segment", *_OPEN), kind).select(*columns)
    whole = done.withColumn("whole", F.lit(True)).unionByName(long.withColumn("whole", F.lit(False)))
    return whole.withColumnRenamed("conv", id_col)


def summary(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: (id_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``repaired_sha256`` is the digest of the repaired turns, ``role:text`` joined by
    line breaks. The pieces of a long conversation are read as a stream in order,
    because a digest needs that; whole ones stay where they are.
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct_turns"), F.lit(0)).alias("gaps")
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.where("whole").select(id_col, gaps, *counts, "audit", F.sha2(text, 256).alias("repaired_sha256"))
    named = pieces.where("NOT whole").drop("whole").withColumnRenamed(id_col, "conv")
    result = {"gaps": pa.int64(), **{c: pa.int64() for c in counts}, "audit": pa.string(), "repaired_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, types = False, None
        conv, total, letters, digest, empty, initial, low, high, distinct = None, {}, [], None, True, None, None, None, 0

        def emit() -> pa.RecordBatch:
            found = {"conv": conv, "gaps": 0 if low is None else high - low + 1 - distinct, "audit": "".join(letters)}
            return _batch([found | total | {"repaired_sha256": digest.hexdigest()}], types)

        for batch in batches:
            types = {"conv": batch.schema.field("conv").type} | result
            for piece in batch.to_pylist():
                if not begun or piece["conv"] != conv:
                    if begun:
                        yield emit()
                    begun, conv, total, letters, digest = True, piece["conv"], dict.fromkeys(counts, 0), [], hashlib.sha256()
                    empty, initial, low, high, distinct = True, None, None, None, 0
                for c in counts:
                    total[c] += piece[c]
                letters.append(piece["audit"])
                for turn in piece["turns"]:
                    digest.update(f"{'' if empty else chr(10)}{turn['role']}:{turn['text']}".encode())
                    empty = False
                if piece["turns_read"]:
                    if initial is not None and initial + piece["first_initial"] not in LEGAL_PAIRS:
                        total["illegal"] += 1
                    initial = piece["last_initial"]
                if piece["first_turn"] is not None:
                    # Turns are in order: only the last number of the piece before can come again.
                    distinct += piece["distinct_turns"] - (high == piece["first_turn"])
                    low = piece["first_turn"] if low is None else low
                    high = piece["last_turn"]
        if begun:
            yield emit()

    kind = pieces.schema[id_col].dataType.simpleString()
    columns = ", ".join(f"{n} {'string' if t == pa.string() else 'bigint'}" for n, t in result.items())
    long = _grouped(named, "conv", "segment").mapInArrow(run, f"conv {kind}, {columns}")
    return whole.unionByName(long.withColumnRenamed("conv", id_col))

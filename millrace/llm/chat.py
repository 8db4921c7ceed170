"""Chat formatting into budgeted, turn-aligned windows.

Each turn costs the tokens of its formatted text under a given vocabulary, or
without one its characters. Prefix sums of these costs cut long conversations into
segments, which are formatted independently: turns are put in ranges of one total
order, sums are taken within ranges and carried over, so that a very long
conversation needs no task of its own. Inside a segment windows are filled turn
by turn. A window that does not begin the conversation repeats the system turn
and a limited history as far as they fit beside its first new turn; repeated turns
are never under the loss mask, so every assistant text is a target once.

Template: ``### role:`` and a line break, the text, ``</turn>`` and a line break.
Backslash, ``#`` and ``<`` are escaped with a backslash in texts, also ``:`` in
roles, so control strings inside a text cannot be taken for marks.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import ranks_of
from millrace.llm.common import staged, text_of
from millrace.operators.ranges import RANGE, ROW, edges, stored_ranges, with_carried

BUDGET, HISTORY = 512, 128
# A segment has room for this many windows.
SEGMENT_WINDOWS = 16
SYSTEM, TARGET = "system", "assistant"

_TEXT_MARKS, _ROLE_MARKS = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*):\n([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.DOTALL)


def escape(text: str, marks: re.Pattern = _TEXT_MARKS) -> str:
    return marks.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted text; raises if it is not one."""
    at = 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        yield unescape(found.group(1)), unescape(found.group(2))
        at = found.end()


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a turn."""
    return f"### {escape(role, _ROLE_MARKS)}:\n", escape(text), "</turn>\n"


def _costed(rows: DataFrame, vocabulary: bytes | None, pattern: str | None) -> DataFrame:
    """Rows (conv, turn, role, text) with the cost of each turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len
        if vocabulary is not None:
            import tiktoken

            tokens = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks_of(vocabulary), special_tokens={})
            size = lambda text: len(tokens.encode_ordinary(text))
        for batch in batches:
            turns = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            costs = pa.array([size("".join(formatted(*t))) for t in turns], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, costs], [*batch.schema.names, "cost"])

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv {kind}, turn bigint, role string, text string, cost bigint")


class _Writer:
    """Windows of one segment, from its turns in order; holds one window and the history at most."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.past: deque = deque()  # (role, text, cost), newest last, within the history's budget
        self.past_cost = 0
        self.repeated: list[tuple] = []
        self.turns: list[tuple] = []
        self.cost = 0

    def remember(self, turn: tuple) -> None:
        self.past.append(turn)
        self.past_cost += turn[2]
        while self.past and self.past_cost > self.history:
            self.past_cost -= self.past.popleft()[2]

    def add(self, turn: tuple, first: bool) -> tuple | None:
        """Take a turn; gives the window it did not fit in, if any."""
        done = None
        if self.turns and self.cost + turn[2] > self.budget:
            done = self.window()
        if not self.turns:
            self.repeated = [] if first else self._prefix(turn[2])
            self.cost = sum(t[2] for t in self.repeated)
        self.turns.append(turn)
        self.cost += turn[2]
        if first and turn[0] == SYSTEM:
            self.system = turn  # part of every window, so never part of the history
        else:
            self.remember(turn)
        return done

    def _prefix(self, cost: int) -> list[tuple]:
        room = self.budget - cost
        kept = [self.system] if self.system and self.system[2] <= room else []
        room -= sum(t[2] for t in kept)
        past: list[tuple] = []
        for turn in reversed(self.past):
            room -= turn[2]
            if room < 0:
                break
            past.append(turn)
        return kept + past[::-1]

    def window(self) -> tuple | None:
        """(text, where new turns begin, loss spans, cost) of the open window, which is closed."""
        if not self.turns:
            return None
        out, size, spans, begin = [], 0, [], 0
        for i, (role, text, _) in enumerate(self.repeated + self.turns):
            if i == len(self.repeated):
                begin = size
            head, body, tail = formatted(role, text)
            if i >= len(self.repeated) and role == TARGET:
                spans.append({"start": size + len(head), "end": size + len(head) + len(body)})
            out += [head, body, tail]
            size += len(head) + len(body) + len(tail)
        cost = self.cost
        self.turns, self.repeated, self.cost = [], [], 0
        return "".join(out), begin, spans, cost


def windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    vocabulary: bytes | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(id_col, segment, window, text, new_from, loss, cost): the windows of each conversation in order.

    ``new_from`` is where new turns begin after repeated ones, ``loss`` the spans
    (code points, end exclusive) of assistant texts to learn. Costs, ``budget`` and
    ``history`` are in tokens of ``vocabulary`` (a rank file's content, with the
    ``pattern`` that splits texts), else in characters. No window costs more than
    ``budget`` unless its only new turn does, which then stands alone: turns are
    never cut. A system turn that leaves no room for a new turn is not repeated
    beside it. Null roles and texts count as empty. Turns of one number (repeated
    rows included, each kept) are ordered by role and text, null numbers come first;
    rows without an id are one conversation. An empty table gives no rows. Other
    columns are not read, whatever their names.
    """
    if history >= budget:
        raise ValueError("the history must be smaller than the budget")
    rows = turns.select(
        F.col(id_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        text_of(role_col).alias("role"), text_of(text_col).alias("text"),
    )
    # Written with their costs, which would else be counted again for the bounds of the ranges.
    rows = staged(_costed(rows, vocabulary, pattern), "turns")
    rows = stored_ranges(rows, [F.col(c) for c in ("conv", "turn", "role", "text")])
    inside = F.sum("cost").over(Window.partitionBy(RANGE, "conv").orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy(RANGE, "conv").agg(F.sum("cost").alias("total"), F.min(ROW).alias("begin"), F.max(ROW).alias("end"))
    over = Window.partitionBy("conv").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    base = edges(parts, "begin", "end").select(RANGE, "conv", F.sum("total").over(over).alias("base"))
    length = SEGMENT_WINDOWS * budget
    placed = (
        with_carried(rows.withColumn("inside", inside), base, ["conv"], ["base"])
        .withColumn("before", F.coalesce("inside", F.lit(0)) + F.coalesce("base", F.lit(0)))
        .withColumn("segment", F.floor(F.col("before") / length).cast("bigint"))
        .select("conv", "segment", "before", "role", "text", "cost")
    )
    # 0: the system turn, 1: history from the segment before, 2: the segment's own turns.
    late = F.col("before") + history >= (F.col("segment") + 1) * length
    own = placed.withColumn("copies", F.when(late, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(2))))
    own = own.withColumn("kind", F.explode("copies")).drop("copies")
    own = own.withColumn("segment", F.when(F.col("kind") == 1, F.col("segment") + 1).otherwise(F.col("segment")))
    system = placed.where((F.col("before") == 0) & (F.col("role") == SYSTEM)).withColumn("kind", F.lit(0)).drop("segment")
    later = placed.where("segment > 0").select(F.col("conv").alias("c"), "segment").distinct()
    system = system.join(later, F.col("conv").eqNullSafe(F.col("c"))).select(*own.columns)
    dealt = own.unionByName(system).repartition("conv", "segment").sortWithinPartitions("conv", "segment", "kind", "before")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    names = ["id", "segment", "window", "text", "new_from", "loss", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, group, number, out = None, None, 0, []
        id_type = pa.int64()

        def emit() -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.list_(span), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        def keep(window: tuple | None) -> None:
            nonlocal number
            if window:
                out.append((*group, number, *window))
                number += 1

        for batch in batches:
            id_type = batch.schema.field("conv").type
            cells = [batch.column(c).to_pylist() for c in ("conv", "segment", "kind", "before", "role", "text", "cost")]
            for conv, segment, kind, before, role, text, cost in zip(*cells, strict=True):
                if writer is None or group != (conv, segment):
                    if writer:
                        keep(writer.window())
                    writer, group, number = _Writer(budget, history), (conv, segment), 0
                turn = (role, text, cost)
                if kind == 0:
                    writer.system = turn
                elif kind == 1:
                    if not (before == 0 and role == SYSTEM):
                        writer.remember(turn)
                else:
                    keep(writer.add(turn, before == 0))
            if out:
                yield emit()
                out = []
        if writer:
            keep(writer.window())
        if out:
            yield emit()

    kind = turns.schema[id_col].dataType.simpleString()
    found = dealt.select("conv", "segment", "kind", "before", "role", "text", "cost").mapInArrow(
        run,
        f"id {kind}, segment bigint, window int, text string, new_from bigint,"
        " loss array<struct<start:bigint,end:bigint>>, cost bigint",
    )
    return found.withColumnRenamed("id", id_col)


def read_back(found: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the windows alone.

    Windows are read in order as a stream with running digests, so a long
    conversation takes no memory.
    """
    order = ("id", "segment", "window")
    rows = found.withColumnRenamed(id_col, "id").select(*order, "text", "new_from", "loss")
    rows = rows.repartition("id").sortWithinPartitions(*order)
    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        id_type = pa.int64()

        def emit(done: list[list]) -> pa.RecordBatch:
            cells = [(i, n, a.hexdigest(), c, b.hexdigest(), f) for i, n, a, c, b, f in done]
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells, strict=True), types, strict=True)], names)

        for batch in batches:
            done = []
            id_type = batch.schema.field("id").type
            cells = [batch.column(c).to_pylist() for c in ("id", "text", "new_from", "loss")]
            for conv, text, begin, loss in zip(*cells, strict=True):
                if state is None or state[0] != conv:
                    if state:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(text[begin:]):
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    target = unescape(text[span["start"] : span["end"]])
                    state[3] += len(target)
                    state[4].update(target.encode())
                state[5] += len(text)
            if done:
                yield emit(done)
        if state:
            yield emit([state])

    kind = found.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(
        run,
        f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
    return out.withColumnRenamed("id", id_col)

"""Conversation structure: faults of turns, and the cheapest repair by generalised LR.

The roles of a conversation must spell ``(system? (user assistant)+)?``.  The LR
automaton of that grammar has four states: EMPTY, after a SYSTEM turn, after a
USER turn, and after whole PAIRS (a reduced ``pairs pair`` looks like ``pair``).  A
graph-structured stack holds, after each turn, one top per state that some edits
lead to; tops of the same state are merged by the minimum of (cost, audit), and a
top's edge to the one before carries the letters of its edits.  Edits of a turn:
Keep (0), Rerole to user or assistant (3), Delete (4, required for blank and
duplicate turns), and Insert of an empty user or assistant turn (3) anywhere; a
truncated turn that stays adds 3.  The audit is the edits' initials; of equal costs
the ASCII-least audit wins.

Costs and ranks suffice to merge: after a turn, no two tops have the same audit or
one that begins with the other (each ends with the letter of that turn), so their
order never changes and a rank stands for the string.  An insertion before a
deletion is never better than after it.  Hence what a run of turns does to the
stack is a 4 x 4 table of (cost, rank), and tables can be composed.

At scale: turns are range-sorted by (conversation, turn, hash of role and text).
A conversation inside one partition is repaired there.  Of one that reaches the edge
of a partition, each partition makes its table from every state it may be entered
in; tables are composed per conversation, and each partition then finds the edits
of its own part for the states that were chosen.  So a conversation that holds a
third of all turns is spread over many tasks; only its digest, a SHA-256, has to
be taken in order, which streams the repaired text and holds nothing.  Repeated
rows are counted before any of that, first per task.

Faults, the first that fits counts: ``blank`` (nothing but U+0020, U+0009 to
U+000D), ``duplicate`` (role and text seen earlier in the conversation),
``truncated`` (last character but white space is none of ``.!?``).

Defined cases: turns without a number come first; turns of one number stand in the
order of the SHA-256 of ``<length of role>:<role><text>``; a null role or text
counts as one space; a null id is a conversation like any other; texts of any
length are read whole; without rows there is no conversation.  Only the four named
columns are read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportflow.session import ensure_checkpoint_dir

SPACES = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
EMPTY, SYSTEM, USER, PAIRS = STATES = range(4)
GOTO = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIRS, (PAIRS, "u"): USER}
ACCEPT = (EMPTY, PAIRS)
ROLES = {"u": "user", "a": "assistant"}


def _inserts(state: int) -> list[int]:
    """The states after 0, 1 and 2 insertions."""
    out = [state]
    for _ in range(2):
        out.append(next(GOTO[out[-1], r] for r in ROLES if (out[-1], r) in GOTO))
    return out


def _actions(initial: str, cut: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest (cost, letters) over a turn from each state to each other one."""
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(a: int, b: int | None, cost: int, letters: str) -> None:
        if b is not None:
            best[a, b] = min(best.get((a, b), (cost, letters)), (cost, letters))

    for a in STATES:
        offer(a, a, DELETE, "D")
        for k, b in enumerate(_inserts(a)):
            extra, before = k * INSERT + (CUT if cut else 0), "I" * k
            offer(a, GOTO.get((b, initial)), extra + KEEP, before + "K")
            for r in ROLES:
                offer(a, GOTO.get((b, r)), extra + REROLE, before + "R")
    return best


ACTIONS = {(i, cut): _actions(i, cut) for i in ("s", "u", "a", "") for cut in (False, True)}


class Step(NamedTuple):
    """What a turn does to the tops: added to all costs, new tops, and where each came from."""
    base: int
    tops: tuple
    back: dict[int, tuple[int, str]]


def _step(tops: tuple, turn: tuple[str, bool]) -> Step:
    """Tops are (state, cost above the least, rank), by state."""
    found: dict[int, tuple] = {}
    by_state = {s: (c, r) for s, c, r in tops}
    for (a, b), (cost, letters) in ACTIONS[turn].items():
        if a in by_state:
            c, r = by_state[a]
            way = (c + cost, r, letters, a)
            found[b] = min(found.get(b, way), way)
    base = min(w[0] for w in found.values())
    order = sorted(found, key=lambda b: found[b][1:3])
    new = tuple((b, found[b][0] - base, order.index(b)) for b in sorted(found))
    return Step(base, new, {b: (w[3], w[2]) for b, w in found.items()})


class Stack:
    """A graph-structured stack that was entered in one state."""

    memo: dict[tuple, int] = {}
    steps: list[Step] = []

    def __init__(self, state: int = EMPTY) -> None:
        self.tops, self.cost = ((state, 0, 0),), 0
        self.edges = array("q")             # a step's number, or minus the number of deleted turns

    def push(self, turn: tuple[str, bool]) -> None:
        key = self.tops, turn
        number = self.memo.get(key)
        if number is None:
            number = self.memo[key] = len(self.steps)
            self.steps.append(_step(*key))
        step = self.steps[number]
        self.cost += step.base
        self.tops = step.tops
        self.edges.append(number)

    def delete(self, turns: int) -> None:
        if turns:
            self.cost += DELETE * turns
            self.edges.append(-turns)

    def table(self) -> list[tuple[int, int, int]]:
        """(state, cost, rank) of every top."""
        return [(s, self.cost + c, r) for s, c, r in self.tops]

    def letters(self, state: int) -> Iterator[str]:
        """Edits of each turn in order, along the edges below the top of a state."""
        out = []
        for e in reversed(self.edges):
            if e < 0:
                out.append("D" * -e)
            else:
                state, letters = self.steps[e].back[state]
                out.append(letters)
        return reversed(out)


def accepted(table: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """(cost, state, insertions): the cheapest end, the one of lowest rank if several are."""
    ends = []
    for state, cost, rank in table:
        for k, last in enumerate(_inserts(state)):
            if last in ACCEPT:
                ends.append((cost + k * INSERT, rank, k, state))
                break
    cost, _, k, state = min(ends)
    return cost, state, k


class Turn(NamedTuple):
    turn: int | None
    role: str
    text: str
    blank: bool
    again: bool         # seen at an earlier turn
    cut: bool
    copies: int


class Facts:
    """Counts over consecutive turns of a conversation."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.first = self.last = None
        self.first_role = self.last_role = ""
        self.some = False

    def add(self, t: Turn) -> None:
        role = t.role[:1]
        if t.blank:
            self.blank += t.copies
        else:
            self.duplicate += t.copies - (not t.again)
            self.truncated += t.cut and not t.again
        if self.some:
            self.illegal += self.last_role + role not in LEGAL
        else:
            self.first, self.first_role, self.some = t.turn, role, True
        self.illegal += t.copies - 1            # equal roles side by side
        if t.turn is not None:
            self.distinct += t.turn != self.last or self.last is None
            self.low = t.turn if self.low is None else self.low
            self.high = t.turn
        self.last, self.last_role = t.turn, role

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


LEGAL = ("su", "ua", "au")


def _feed(stack: Stack, t: Turn) -> None:
    if t.blank or t.again:
        stack.delete(t.copies)
    else:
        stack.push((t.role[:1] if t.role[:1] in ("s", "u", "a") else "", t.cut))
        stack.delete(t.copies - 1)


def _lines(turns: list[Turn], stack: Stack, entry: int, end: int, after: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every edit from ``entry`` to ``end`` and ``after`` more insertions."""
    state = entry
    way = stack.letters(end)
    for t in turns:
        if not (t.blank or t.again):
            for x in next(way):
                if x == "D":
                    yield "D", t.role, t.text
                    continue
                role = next(r for r in ROLES if (state, r) in GOTO)
                if x == "K":
                    state = GOTO[state, t.role[:1]]
                    yield "K", t.role, t.text
                else:
                    state = GOTO[state, role]
                    yield x, ROLES[role], t.text if x == "R" else ""
        if t.copies - (not (t.blank or t.again)):
            for _ in next(way):
                yield "D", t.role, t.text
    for _ in range(after):
        role = next(r for r in ROLES if (state, r) in GOTO)
        state = GOTO[state, role]
        yield "I", ROLES[role], ""


_TURN = ("turn", "role", "text", "blank", "again", "cut", "copies")
_RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
# Turn numbers go as text: pandas would make nullable longs doubles.
_PART = ("part int, first string, last string, first_role string, last_role string, low string, high string, "
         "n_distinct bigint, tables array<array<bigint>>")
_PIECE = 1 << 20


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn], bool, int]]:
    """(id, turns, whether it is first or last of the partition, partition) of sorted rows."""
    held: list[Turn] = []
    current, first, part = None, True, 0
    for batch in batches:
        ids, parts = batch.column("conv").to_pylist(), batch.column("part")
        rows = zip(*[batch.column(c).to_pylist() for c in _TURN], strict=True)
        for i, row in zip(ids, rows, strict=True):
            if held and i != current:
                yield current, held, first, part
                held, first = [], False
            current, part = i, parts[0].as_py()
            held.append(Turn(*row))
    if held:
        yield current, held, True, part


def _table(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _repair_inside(schema: pa.Schema):
    """Map pass: results of conversations inside a partition, tables of those at its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for conv, turns, edge, part in _conversations(batches):
            facts, stacks = Facts(), [Stack(s) for s in (STATES if edge else (EMPTY,))]
            for t in turns:
                facts.add(t)
                for s in stacks:
                    _feed(s, t)
            row = {"conv": conv, "blank": facts.blank, "duplicate": facts.duplicate, "truncated": facts.truncated,
                   "illegal": facts.illegal, "gaps": facts.gaps()}
            if edge:
                row |= {"part": part, "first_role": facts.first_role, "last_role": facts.last_role,
                        "n_distinct": facts.distinct,
                        **{k: None if (x := getattr(facts, k)) is None else str(x)
                           for k in ("first", "last", "low", "high")},
                        "tables": [[s, *top] for s, stack in zip(STATES, stacks, strict=True)
                                   for top in stack.table()]}
            else:
                cost, state, after = accepted(stacks[0].table())
                audit, digest = [], hashlib.sha256()
                for edit, line in _written(_lines(turns, stacks[0], EMPTY, state, after)):
                    audit.append(edit)
                    if line is not None:
                        digest.update(line)
                row |= {"cost": cost, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            out.append(row)
            if len(out) >= 4096:
                yield from _table(out, schema)
                out = []
        yield from _table(out, schema)

    return run


def _written(lines: Iterator[tuple[str, str, str]]) -> Iterator[tuple[str, bytes | None]]:
    """Edits with the bytes they add to the repaired conversation (None: deleted)."""
    begun = False
    for edit, role, text in lines:
        if edit == "D":
            yield edit, None
        else:
            yield edit, (("\n" if begun else "") + role + ":" + text).encode("utf-8", "surrogatepass")
            begun = True


_CHOSEN = ("part int, entry int, leave int, after int, gaps bigint, blank bigint, duplicate bigint, "
           "truncated bigint, illegal bigint, cost bigint")


def _compose(parts: pd.DataFrame) -> pd.DataFrame:
    """The states in which a conversation enters and leaves each of its parts, and its counts.

    One row per partition that the conversation lies in, of fixed size.
    """
    parts = parts.sort_values("part").reset_index(drop=True)
    tops = {EMPTY: (0, 0)}                      # state: (cost, rank)
    froms = []
    total = parts[["blank", "duplicate", "truncated", "illegal"]].sum()
    distinct = int(parts["n_distinct"].sum())
    for i, tables in enumerate(parts["tables"]):
        found: dict[int, tuple] = {}
        for entry, state, cost, rank in (map(int, x) for x in tables):
            if entry in tops:
                way = (tops[entry][0] + cost, tops[entry][1], rank, entry)
                found[state] = min(found.get(state, way), way)
        order = sorted(found, key=lambda s: found[s][1:3])
        tops = {s: (found[s][0], order.index(s)) for s in found}
        froms.append({s: w[3] for s, w in found.items()})
        if i:
            a, b = parts.loc[i - 1], parts.loc[i]
            total["illegal"] += (a["last_role"] + b["first_role"]) not in LEGAL
            distinct -= a["last"] is not None and a["last"] == b["first"]
    cost, state, after = accepted([(s, c, r) for s, (c, r) in tops.items()])
    numbers = [int(x) for x in [*parts["low"], *parts["high"]] if x is not None]
    gaps = max(numbers) - min(numbers) + 1 - distinct if numbers else 0
    rows = []
    for i in range(len(parts) - 1, -1, -1):
        entry = froms[i][state]
        rows.append({"part": parts.loc[i, "part"], "entry": entry, "leave": state,
                     "after": after if i == len(parts) - 1 else 0})
        state = entry
    out = pd.DataFrame(rows).assign(gaps=gaps, cost=cost)
    for c in total.index:
        out[c] = int(total[c])
    return out.assign(conv=[parts.loc[0, "conv"]] * len(out))


def _repair_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map pass over rows of chosen parts: their edits and repaired lines in pieces."""
    held: list[Turn] = []
    here = None
    for batch in batches:
        key = zip(batch.column("conv").to_pylist(), *[batch.column(c).to_pylist() for c in
                                                      ("part", "entry", "leave", "after")], strict=True)
        rows = zip(*[batch.column(c).to_pylist() for c in _TURN], strict=True)
        for k, row in zip(key, rows, strict=True):
            if held and k != here:
                yield from _pieces(here, held, batch.schema.field("conv").type)
                held = []
            here = k
            held.append(Turn(*row))
        kind = batch.schema.field("conv").type
    if held:
        yield from _pieces(here, held, kind)


def _pieces(key: tuple, turns: list[Turn], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    conv, part, entry, leave, after = key
    stack = Stack(entry)
    for t in turns:
        _feed(stack, t)

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([part], pa.int32()), pa.array([number], pa.int64()),
             pa.array(["".join(audit)], pa.string()), pa.array([b"\n".join(lines) if lines else None], pa.binary())],
            ["conv", "part", "number", "audit", "lines"])

    number, audit, lines, size = 0, [], [], 0
    for edit, role, text in _lines(turns, stack, entry, leave, after):
        audit.append(edit)
        if edit != "D":
            lines.append(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            size += len(lines[-1])
        if size + len(audit) >= _PIECE:
            yield piece()
            number, audit, lines, size = number + 1, [], [], 0
    yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map pass over pieces sorted by conversation, part and number: audit and digest of each."""
    here, audit, digest, begun, some = None, [], hashlib.sha256(), False, False

    def done(kind):
        return pa.RecordBatch.from_arrays(
            [pa.array([here], kind), pa.array(["".join(audit)], pa.string()),
             pa.array([digest.hexdigest()], pa.string())], ["conv", "audit", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for conv, letters, lines in zip(batch.column("conv").to_pylist(), batch.column("audit").to_pylist(),
                                        batch.column("lines").to_pylist(), strict=True):
            if some and conv != here:
                yield done(kind)
                audit, digest, begun = [], hashlib.sha256(), False
            here, some = conv, True
            audit.append(letters)
            if lines is not None:
                digest.update((b"\n" if begun else b"") + lines)
                begun = True
    if some:
        yield done(kind)


def _sorted_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns with their faults and copies, range-sorted, written to the checkpoint folder."""
    x = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                    F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    x = x.withColumn("hash", F.unhex(F.sha2(F.concat(
        F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    turns = x.groupBy("conv", "turn", "hash").agg(
        F.first("role").alias("role"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    # Contents at several turns, with the first of them (the struct keeps a null turn, which is least).
    first = x.groupBy(F.col("conv").alias("c"), F.col("hash").alias("h")).agg(
        F.min(F.struct("turn")).alias("lo"), F.max(F.struct("turn")).alias("hi")).filter(~F.col("lo").eqNullSafe(F.col("hi")))
    on = turns["conv"].eqNullSafe(first["c"]) & (turns["hash"] == first["h"])
    stripped = F.rtrim(F.col("text"), F.lit(SPACES))
    again = F.col("lo").isNotNull() & ~F.col("lo.turn").eqNullSafe(F.col("turn"))
    turns = turns.join(first, on, "left").select(
        "conv", "turn", "hash", "role", "text", (stripped == "").alias("blank"), again.alias("again"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut"), "copies")
    turns = turns.repartitionByRange("conv", "turn", "hash").sortWithinPartitions("conv", "turn", "hash")
    return turns.drop("hash").checkpoint().withColumn("part", F.spark_partition_id())


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``gaps`` counts turn numbers missing between the least and the largest,
    ``illegal`` neighbours whose roles' initials are not su, ua or au; the digest
    is of the repaired ``role:text`` lines.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    turns = _sorted_turns(rows, conv_col, turn_col, role_col, text_col)
    kind = turns.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {_RESULT}, {_PART}"
    arrow = rows.sparkSession.createDataFrame([], schema).toArrow().schema
    done = turns.mapInArrow(_repair_inside(arrow), schema).checkpoint()
    inside = done.filter("part IS NULL")
    chosen = done.filter("part IS NOT NULL").groupBy("conv").applyInPandas(
        _compose, f"conv {kind}, {_CHOSEN}").checkpoint()
    # Two rows per partition at most, whatever the input.
    places = F.broadcast(chosen.select(F.col("conv").alias("c"), F.col("part").alias("p"), "entry", "leave", "after"))
    parts = turns.join(places, turns["conv"].eqNullSafe(F.col("c")) & (turns["part"] == F.col("p")))
    pieces = parts.mapInArrow(_repair_parts, f"conv {kind}, part int, number bigint, audit string, lines binary")
    texts = pieces.repartition("conv").sortWithinPartitions("conv", "part", "number").mapInArrow(
        _digests, f"conv {kind}, audit string, repaired_sha256 string").withColumnRenamed("conv", "c")
    counts = chosen.drop("part", "entry", "leave", "after").distinct()
    across = counts.join(texts, counts["conv"].eqNullSafe(texts["c"])).drop("c")
    return inside.select(*across.columns).unionByName(across).select(
        F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")

"""Conversation repair: cheapest edits to a legal order of roles, found with Four-Russians block tables.

A conversation is legal if its roles' initials spell nothing, or an optional s and then u and a in turn. The rows become symbols
(what the role starts with, and the row's fault), and an edit sequence is a path through a small automaton. For each place the cheapest
cost to go from each of its four states is a vector; less its least cost it is one of a few dozen vectors, as two inserted rows lead from any
state to any other. So the step over a block of BLOCK symbols is a table: block and vector behind it -> vector before it and the
cost between. Vectors are looked up block by block from the end of a conversation, and only those between blocks are kept. The
trace goes forward: a block is expanded backward from the vector behind it, and of the edits that keep to the least cost the
first by letter is taken, which gives the least of all cheapest edit strings. Expanded blocks are remembered, too.

One task reads a conversation in order, as its edits and digest depend on all of it. It holds one byte for each row (the
edit string that it returns has as many), never texts: these stream past in a second pass, edits first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfspark.llm.common import materialise, scratch

DELETE, REROLE, INSERT, LATE = 2, 1, 5, 5
BLOCK = 4
#: States: nothing so far, after s, after u, after a. What is kept leads from one to another; a new u or a fits all but one place.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
FINAL = (0, 3)
#: Symbols: a row's initial (s, u, a, other), the same of truncated rows, a row that must go, and none (it fills the last block).
INITIALS = "sua"
MUST_GO, NO_ROW, SYMBOLS = 8, 9, 10
Vector = tuple[int, ...]


def to_new(state: int) -> int:
    """The state after a new row, which is assistant after u and user everywhere else."""
    return 3 if state == 2 else 2


def kept_to(state: int, symbol: int) -> int | None:
    role = symbol % 4
    return KEPT.get((state, INITIALS[role])) if symbol < MUST_GO and role < 3 else None


def before(symbol: int, behind: Vector) -> Vector:
    """Cheapest costs to go before a row, from those behind it."""
    if symbol == NO_ROW:
        return behind
    cost = [DELETE + x for x in behind]
    if symbol < MUST_GO:
        late = LATE if symbol >= 4 else 0
        for state in range(4):
            cost[state] = min(cost[state], REROLE + late + behind[to_new(state)])
            if (to := kept_to(state, symbol)) is not None:
                cost[state] = min(cost[state], late + behind[to])
    u, a = min(cost[2], INSERT + cost[3]), min(cost[3], INSERT + cost[2])
    return min(cost[0], INSERT + u), min(cost[1], INSERT + u), u, a


LAST: Vector = (0, 2 * INSERT, INSERT, 0)


class Tables:
    """All normalised vectors, one-symbol steps, and the steps over blocks made from them."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors, place = block, [LAST], {LAST: 0}
        steps: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows as new vectors are found
            row = []
            for symbol in range(SYMBOLS):
                new = before(symbol, vector)
                least = min(new)
                norm = tuple(x - least for x in new)
                if norm not in place:
                    place[norm] = len(self.vectors)
                    self.vectors.append(norm)
                row.append((place[norm], least))
            steps.append(row)
        self.step = np.array([[to for to, _ in row] for row in steps])
        self.cost = np.array([[c for _, c in row] for row in steps])
        codes = np.arange(SYMBOLS**block)
        self.to = np.repeat(np.arange(len(steps))[:, None], len(codes), 1)
        self.total = np.zeros_like(self.to)
        for k in range(block):  # the last symbol of a block comes first
            symbol = codes // SYMBOLS**k % SYMBOLS
            self.total += self.cost[self.to, symbol]
            self.to = self.step[self.to, symbol]
        self.expand = cache(self._expand)

    def symbols_of(self, code: int) -> list[int]:
        return [code // SYMBOLS**k % SYMBOLS for k in range(self.block - 1, -1, -1)]

    def _expand(self, code: int, behind: int, state: int) -> tuple[str, int]:
        """The first by letter of a block's cheapest edits from a state, and the state after them."""
        symbols, inner = self.symbols_of(code), [behind]
        for symbol in reversed(symbols):
            inner.append(int(self.step[inner[-1], symbol]))
        inner.reverse()
        edits = ""
        for symbol, at, after in zip(symbols, inner, inner[1:], strict=False):
            if symbol == NO_ROW:
                continue
            here, there = self.vectors[at], self.vectors[after]
            left = lambda s: here[s] + int(self.cost[after, symbol])  # noqa: B023, E731  costs are told from those behind the row
            while True:
                late = LATE if 4 <= symbol < MUST_GO else 0
                if DELETE + there[state] == left(state):
                    edits += "D"
                    break
                if INSERT + here[to_new(state)] == here[state]:
                    edits, state = edits + "I", to_new(state)
                    continue
                to = kept_to(state, symbol)
                if to is not None and late + there[to] == left(state):
                    edits, state = edits + "K", to
                else:
                    edits, state = edits + "R", to_new(state)
                break
        return edits, state

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """The least cost of a conversation's edits, and the first by letter of such edit strings."""
        padded = np.frombuffer(symbols + bytes([NO_ROW]) * (-len(symbols) % self.block), np.uint8).reshape(-1, self.block)
        codes = (padded.astype(np.int64) @ SYMBOLS ** np.arange(self.block - 1, -1, -1)).tolist()
        behind, total, vector = np.zeros(len(codes), np.uint8 if len(self.vectors) < 256 else np.int32), 0, 0
        for k in range(len(codes) - 1, -1, -1):
            behind[k] = vector
            total += int(self.total[vector, codes[k]])
            vector = int(self.to[vector, codes[k]])
        cost, state, edits = total + self.vectors[vector][0], 0, []
        for code, v in zip(codes, behind.tolist(), strict=True):
            some, state = self.expand(code, v, state)
            edits.append(some)
        while state not in FINAL:
            edits.append("I")
            state = to_new(state)
        return cost, "".join(edits)


@cache
def tables() -> Tables:
    return Tables()


def damage(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) with planted faults, told by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text, 2 takes
    out `.`, `!` and `?`, 3 repeats it, 4 makes its role user. Nulls are one blank in roles, texts and that name."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.encode(F.concat(of("conv_id"), F.lit(":"), of("turn")), "utf-8")), F.lit(20))
    rows = turns.select("conv_id", "turn", of("role").alias("role"), of("text").alias("text"), kind.alias("__kind")).filter("__kind <> 0")
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("__kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("__copy")).drop("__copy")


def _given(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _faulty(rows: DataFrame) -> DataFrame:
    """rows with their initial, what tells equal rows, and their fault, but for copies within a turn, which stand next to each other."""
    body = r"[^\x20\x09-\x0D]"
    told = rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(31), "role", "text"), "at": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    first = told.groupBy(F.col("conv_id").alias("__c"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2")).agg(F.min("at").alias("__first"), F.max("at").alias("__last"))
    first = first.filter(F.col("__first") < F.col("__last")).drop("__last")  # only rows that come again in another turn
    same = F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))
    found = told.join(first, same, "left")
    fault = (
        F.when(~F.col("text").rlike(body), "blank").when(F.col("at") > F.col("__first"), "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    )
    return found.select("conv_id", "turn", "role", "text", "h1", "h2", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _plans(conv: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    class Conversation:
        def __init__(self, ident):
            self.ident, self.symbols = ident, bytearray()
            self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
            self.illegal = self.turns = 0
            self.least = self.turn = self.row = self.initial = None

        def add(self, turn, initial: str, h1: int, h2: int, fault: str | None) -> None:
            if fault != "blank" and (turn, h1, h2) == self.row:
                fault = "duplicate"
            self.row = turn, h1, h2
            if turn is not None and turn != self.turn:
                self.turns += 1
                self.least = turn if self.least is None else self.least
                self.turn = turn
            self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
            self.initial = initial
            if fault:
                self.faults[fault] += 1
            role = INITIALS.find(initial) if initial else -1
            self.symbols.append(MUST_GO if fault in ("blank", "duplicate") else (role if role >= 0 else 3) + 4 * (fault == "truncated"))

        def done(self) -> tuple:
            cost, audit = tables().repair(bytes(self.symbols))
            gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
            return self.ident, gaps, *self.faults.values(), self.illegal, cost, audit

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [conv, *[pa.int64()] * len(REPORT), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["conv_id", *REPORT, "audit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        for batch in batches:
            ready = []
            for ident, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "h1", "h2", "fault")), strict=True):
                if now is None or ident != now.ident:
                    if now is not None:
                        ready.append(now.done())
                    now = Conversation(ident)
                now.add(*row)
            if ready:
                yield batch_of(ready)
        if now is not None:
            yield batch_of([now.done()])

    return run


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, "turn", "role", "text")


def plan_repairs(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) -> for each conversation with rows: gaps, blank, duplicate, truncated, illegal, cost and audit.

    Rows are taken by turn (nulls first), then role and text. A row's first fault counts: blank (no character other than ASCII
    blanks), duplicate (role and text of an earlier row), truncated (its last such character isn't `.`, `!` or `?`). gaps are the turn numbers
    that are missing between the least and the largest, illegal the neighbours whose initials aren't su, ua or au. audit has the initials of the cheapest
    edits in order: Keep (free), Rerole to user or assistant (1), Delete (2, for blank and duplicate rows the only one), Insert an empty
    user or assistant row (5); a truncated row that isn't deleted costs 5 more. Of equally cheap ones the first by letter is taken.

    Null roles and texts are empty; a null conv_id is a conversation of its own; repeated rows are duplicates. Other columns are neither
    read nor returned. An empty table gives an empty result. conv_id keeps its type; rows are equal when two 64-bit hashes agree.
    """
    rows = _faulty(_given(turns))
    kind = rows.schema["conv_id"].dataType
    fields = [StructField("conv_id", kind), *(StructField(c, LongType()) for c in REPORT), StructField("audit", StringType())]
    ordered = _in_order(rows).select("conv_id", "turn", "initial", "h1", "h2", "fault")
    return ordered.mapInArrow(_plans(_arrow_type(kind)), StructType(fields))


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _repaired(conv: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A conversation's edits, then its rows -> its repaired rows."""
    kinds = [conv, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ident, audit, at, pos, state = None, "", 0, 0, 0
        out: list[tuple] = []

        def emit(turn, role: str, text: str, edit: str) -> None:
            nonlocal pos, state
            state = to_new(state) if edit != "K" else KEPT[state, role[:1]]
            out.append((ident, pos, turn, role, text, edit))
            pos += 1

        def new_role() -> str:
            return "assistant" if state == 2 else "user"

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                emit(None, new_role(), "", "I")
                at += 1

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["conv_id", "pos", "turn", "role", "text", "edit"])
            out.clear()
            return made

        for batch in batches:
            columns = ("conv_id", "is_row", "turn", "role", "text", "audit")
            for c, is_row, turn, role, text, edits in zip(*(batch.column(x).to_pylist() for x in columns), strict=True):
                if not is_row:
                    insert()  # what the conversation before ends with
                    ident, audit, at, pos, state = c, edits, 0, 0, 0
                    continue
                insert()
                edit, at = audit[at], at + 1
                if edit != "D":
                    emit(turn, new_role() if edit == "R" else role, text, edit)
                if len(out) >= 5000:
                    yield flush()
            if out:
                yield flush()
        insert()
        if out:
            yield flush()

    return run


def apply_repairs(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) and their plans -> repaired rows (conv_id, pos, turn, role, text, edit), a conversation's in order
    within one partition; inserted rows have no turn. plans must come from plan_repairs over the same turns."""
    kind = turns.schema["conv_id"].dataType
    none = lambda t, name: F.lit(None).cast(t).alias(name)
    edits = plans.select("conv_id", F.lit(False).alias("is_row"), none("long", "turn"), none("string", "role"), none("string", "text"), "audit")
    rows = _given(turns).select("conv_id", F.lit(True).alias("is_row"), "turn", "role", "text", none("string", "audit"))
    fields = [("conv_id", kind), ("pos", LongType()), ("turn", LongType()), ("role", StringType()), ("text", StringType()), ("edit", StringType())]
    return _in_order(edits.union(rows), "is_row").mapInArrow(_repaired(_arrow_type(kind)), StructType([StructField(*f) for f in fields]))


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired rows as apply_repairs gives them: `role:text` of each row, joined by newlines."""
    kind = repaired.schema["conv_id"].dataType
    conv = _arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ident = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([ident], conv), pa.array([now.hexdigest()])], names=["conv_id", "repaired_sha256"])
        for batch in batches:
            for c, pos, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "pos", "role", "text")), strict=True):
                if pos == 0:
                    if now is not None:
                        yield row()
                    now, ident = hashlib.sha256(), c
                now.update(f"{chr(10) if pos else ''}{role}:{text}".encode())
        if now is not None:
            yield row()

    return repaired.select("conv_id", "pos", "role", "text").mapInArrow(run, StructType([StructField("conv_id", kind), StructField("repaired_sha256", StringType())]))


def repair_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """For each distinct conv_id of conversations: the report of plan_repairs over turns, and the digest of the repaired rows. A conversation
    without rows has zeros, an empty audit and the digest of nothing; so has one whose rows are all deleted, but for its report."""
    every = conversations.select("conv_id").distinct()
    with scratch(turns.sparkSession):
        plans = materialise(plan_repairs(turns), "plans", keep=True)
        found = materialise(digests(apply_repairs(turns, plans)), "digests", keep=True)
    out = every.withColumnRenamed("conv_id", "__c")
    for part in (plans, found):
        out = out.join(part, F.col("__c").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    nothing = hashlib.sha256(b"").hexdigest()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in REPORT]
    return out.select(F.col("__c").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))

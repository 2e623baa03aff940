"""Chat formatting: a finite-state machine over roles, a declarative template, and segments with loss flags.

A conversation is read turn by turn in one pass, so that its length is bounded by no one's memory: the machine's state and
the digests are all that is kept between turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are trained on, and which role may follow which ("" is the start)."""

    turn_open: str = "<|im_start|>"
    after_role: str = "\n"
    turn_close: str = "<|im_end|>\n"
    trained: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {
        "": frozenset({"system", "user"}), "system": frozenset({"user"}),
        "user": frozenset({"assistant"}), "assistant": frozenset({"user"}),
    })
    final: frozenset[str] = frozenset({"assistant"})


_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No `<|` is left: each gets a backslash in between, and one more where there were some already."""
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


SEGMENT_SCHEMA = "conv_id long, pos long, segment string, loss boolean, state string"


def _segments(template: Template) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("segment", pa.string()), ("loss", pa.bool_()), ("state", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: object = ()
        state, pos = "", 0
        for batch in batches:
            out: list[tuple] = []
            for c, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text")), strict=True):
                if c != conv:
                    conv, state, pos = c, "", 0
                role, text = role or "", text or ""
                # once invalid, a conversation stays so
                state = role if state != "invalid" and role in template.follows.get(state, ()) else "invalid"
                for segment, loss in ((template.turn_open + escape_role(role) + template.after_role, False), (escape(text), role in template.trained), (template.turn_close, False)):
                    out.append((c, pos, segment, loss, state))
                    pos += 1
                if len(out) >= 3000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """turns(conv_id, turn, role, text) -> segments (conv_id, pos, segment, loss, state), three for each turn.

    Joined in the order of pos, a conversation's segments are its formatted text; loss marks those to train on, which are the
    texts of trained roles and nothing else. state is the machine's state after the turn: the role, or `invalid` from the
    first turn on whose role may not follow (invalid conversations are formatted like others, for the caller to drop).

    Control strings inside texts and roles are escaped, and `read_back` restores them exactly. Null texts and roles are
    empty. Rows are taken in the order of turn (null first), then role and text, so ties and repeated rows have one order; a null
    conv_id is a conversation of its own. Very long texts and conversations pass through row by row. An empty table gives no
    segments. Other columns are neither read nor returned.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_segments(template or Template()), SEGMENT_SCHEMA)


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def _digests(template: Template) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    class Conversation:
        def __init__(self, conv):
            self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.chars = 0
            self.held, self.trained, self.state = "", [], ""

        def add(self, segment: str, loss: bool, state: str) -> None:
            self.chars += len(segment)
            self.held += segment
            self.state = state
            if loss:
                plain = unescape(segment)
                self.loss.update(plain.encode())
                self.loss_chars += len(plain)
            # a turn is complete at its closing mark, which no text contains
            if self.held.endswith(template.turn_close):
                body = self.held[len(template.turn_open) : -len(template.turn_close)]
                role, text = body.split(template.after_role, 1)
                self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                self.n_turns += 1
                self.held = ""

        def row(self) -> tuple:
            return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.state in template.final

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        for batch in batches:
            done = []
            for c, segment, loss, state in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "segment", "loss", "state")), strict=True):
                if now is None or c != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = Conversation(c)
                now.add(segment, loss, state)
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([now.row()])

    return run


def read_back(segments: DataFrame, template: Template | None = None, in_order: bool = False) -> DataFrame:
    """What the formatted conversations hold, parsed from the segments: turns, trained text and lengths, and whether the machine accepts.

    One row for each conv_id. An empty table of segments gives an empty result. With in_order, segments are taken as they come from
    format_chats, whole conversations one after another in a partition, and aren't shuffled again. Either way one task reads a
    conversation from its first turn to its last, as digests and the machine's state need that order; it holds one turn at a time.
    """
    ordered = segments if in_order else segments.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return ordered.select("conv_id", "segment", "loss", "state").mapInArrow(_digests(template or Template()), DIGEST_SCHEMA)

"""Chat formatting: a finite-state machine over roles, and text segments from a declarative template.

Conversations are sorted by turn within partitions and run through the machine as a stream, so a task
holds one turn at a time however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Turn:
    """How the turns of a role are written: marks around the text, and whether the text is learned."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of each role, the roles that may follow each state, and the strings that texts must not hold.

    ``other`` writes roles that ``turns`` lacks; its ``{role}`` is the escaped role. Each mark has a
    control string, and no two turns can be read in two ways, since control strings inside texts are
    broken by a backslash after their first character and backslashes are doubled.
    """

    turns: dict[str, Turn]
    other: Turn
    follows: dict[str, tuple[str, ...]]
    control: tuple[str, ...]
    start: str = "start"
    _compiled: dict = field(default_factory=dict, compare=False, repr=False)

    def _pattern(self, name: str, build) -> re.Pattern:
        if name not in self._compiled:
            self._compiled[name] = re.compile(build(), re.S)
        return self._compiled[name]

    def escape(self, text: str) -> str:
        longest_first = sorted(self.control, key=len, reverse=True)
        pattern = self._pattern("escape", lambda: "\\\\|(?:" + "|".join(map(re.escape, longest_first)) + ")")
        return pattern.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._pattern("unescape", lambda: r"\\(\\?)").sub(lambda m: m[1], text)

    def write(self, role: str, text: str) -> tuple[str, str, str, bool]:
        turn = self.turns.get(role, self.other)
        before, after = turn.before, turn.after
        if role not in self.turns:
            before = before.replace("{role}", self.escape(role))
        return before, self.escape(text), after, turn.loss

    def read(self, formatted: str) -> tuple[str, str, int] | None:
        """(role, text, length) of the turn at the start of ``formatted``; None while it is incomplete."""
        for role, turn in self.turns.items():
            if formatted.startswith(turn.before):
                end = formatted.find(turn.after, len(turn.before))
                if end >= 0:
                    return role, self.unescape(formatted[len(turn.before):end]), end + len(turn.after)
        head, tail = self.other.before.split("{role}")
        if formatted.startswith(head):
            middle = formatted.find(tail, len(head))
            end = formatted.find(self.other.after, middle + len(tail)) if middle >= 0 else -1
            if end >= 0:
                return self.unescape(formatted[len(head):middle]), self.unescape(formatted[middle + len(tail):end]), end + len(self.other.after)
        return None


#: A public instruction format, with an extra mark for roles that it lacks.
INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Turn("<s>[INST] ", " [/INST]"),
        "assistant": Turn("<ans> ", " </s>", loss=True),
    },
    other=Turn("<<TURN>>{role}<<TEXT>>", "<</TURN>>"),
    follows={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    control=("<s>", "</s>", "[INST]", "[/INST]", "<ans>", "<<SYS>>", "<</SYS>>", "<<TURN>>", "<<TEXT>>", "<</TURN>>"),
)

SEGMENTS = "conv_id long, place long, text string, loss boolean, error string"
SEGMENT_SCHEMA = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("text", pa.string()), ("loss", pa.bool_()), ("error", pa.string())])


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, last_turn, place = object(), template.start, None, 0
        for batch in batches:
            out = []
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                if conv != current:
                    current, state, last_turn, place = conv, template.start, None, 0
                error = None
                if turn is None or turn == last_turn:
                    error = f"turn {turn} is missing or repeated"
                elif state is None or role not in template.follows.get(state, ()):
                    error = f"{role or 'no role'} after {state}"
                state, last_turn = role if role in template.follows else None, turn
                before, body, after, loss = template.write(role, text)
                out += [(conv, place, before, False, error), (conv, place + 1, body, loss, None), (conv, place + 2, after, False, None)]
                place += 3
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SEGMENT_SCHEMA)], schema=SEGMENT_SCHEMA)
    return run


def chat_segments(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Text segments of every row of ``conversations`` (conv_id, turn, role, text), three for each turn.

    conv_id, place (order in the conversation), text, loss, error (what breaks the turn order, on a turn's
    first segment). The segments of a conversation, one after the other, are its formatted text. Rows are
    ordered by turn, then role and text; null texts and roles are empty, null turns come first, and rows
    without conv_id form one conversation. More columns are ignored; no row is dropped.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_format(template), SEGMENTS)


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "valid boolean, error string")
READ_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("error", pa.string())])


class _Reading:
    """What is read back from the segments of one conversation."""

    def __init__(self, conv, template: Template):
        self.conv, self.template = conv, template
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()
        self.rest, self.error = "", None

    def add(self, text: str, loss: bool, error: str | None) -> None:
        self.error = self.error or error
        self.chars += len(text)
        if loss:
            learned = self.template.unescape(text)
            self.loss_chars += len(learned)
            self.loss_hash.update(learned.encode("utf-8", "surrogatepass"))
        self.rest += text
        while (found := self.template.read(self.rest)) is not None:
            role, body, length = found
            self.turns += 1
            self.turn_hash.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            self.rest = self.rest[length:]

    def row(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv}: the formatted text ends inside a turn")
        return (self.conv, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars,
                self.error is None, self.error)


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading: _Reading | None = None
        for batch in batches:
            done = []
            for conv, text, loss, error in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "error"))):
                if reading is None or reading.conv != conv:
                    if reading is not None:
                        done.append(reading.row())
                    reading = _Reading(conv, template)
                reading.add(text, loss, error)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), READ_SCHEMA)], schema=READ_SCHEMA)
        if reading is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(reading.row(), READ_SCHEMA)], schema=READ_SCHEMA)
    return run


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, parsed from its formatted text: counts and digests of turns and learned text."""
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_read(template), READ)

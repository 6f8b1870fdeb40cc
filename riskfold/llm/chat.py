"""Chat formatting: a finite-state machine over roles and a declarative template.

Each conversation's turns come sorted to one task, which walks them as a
stream: it keeps the machine's state, not the conversation.  A turn becomes
segments (opening marks, escaped text, closing marks), each with a loss flag;
a conversation's formatted text is its segments joined.  The same stream is
read back with nothing but the marks and the flags.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.text import pieces


@dataclass(frozen=True)
class Turn:
    """How a role's turns are written; ``loss``: whether their text counts for the loss."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, the machine's moves (state to role to state) and its end states.

    ``other`` writes all other roles, their escaped name between ``name_open``
    and ``name_close``.  ``control``: the strings that may not occur in a text;
    a backslash after the first character breaks each, and backslashes are
    doubled.
    """

    roles: Mapping[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<s><<SYS>>\n", "\n<</SYS>></s>"),
        "user": Turn("<s>[INST] ", " [/INST]</s>"),
        "assistant": Turn("<s>", "</s>", loss=True),
    })
    other: Turn = Turn("<s>", "</s>")
    name_open: str = "<<ROLE>>"
    name_close: str = "<</ROLE>>"
    control: tuple[str, ...] = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>",
    )
    moves: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    ends: tuple[str, ...] = ("assistant",)

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The next state, and whether the machine allows the move.

        After a move that it does not allow, it goes on as if the role had been
        expected, so that one wrong turn is not counted again at every later one.
        """
        to = self.moves.get(state, {}).get(role)
        return (to, True) if to else (role if role in self.moves else "start", False)

    def escape(self, text: str) -> str:
        return re.sub(
            r"\\|(?=" + "|".join(map(re.escape, self.control)) + ").",
            lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text, flags=re.S,
        )

    def unescape(self, text: str) -> str:
        return re.sub(r"\\\\|\\", lambda m: "\\" if len(m[0]) == 2 else "", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        marks = self.roles.get(role)
        if marks is None:
            marks = Turn(self.other.open + self.name_open + self.escape(role) + self.name_close, self.other.close, self.other.loss)
        return [(marks.open, False), (self.escape(text), marks.loss), (marks.close, False)]

    def parser(self) -> re.Pattern:
        """Matches one turn; its group ``r0``, ``r1``, ... holds a known role's text."""
        known = sorted(enumerate(self.roles.values()), key=lambda x: -len(x[1].open))
        ways = [f"{re.escape(t.open)}(?P<r{i}>.*?){re.escape(t.close)}" for i, t in known]
        other = (f"{re.escape(self.other.open + self.name_open)}(?P<name>.*?){re.escape(self.name_close)}"
                 f"(?P<text>.*?){re.escape(self.other.close)}")
        return re.compile("|".join([other, *ways]), re.S)


def _segment_schema(key: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", key), T.StructField("turn_no", T.LongType(), False),
        T.StructField("segment", T.IntegerType(), False), T.StructField("text", T.StringType(), False),
        T.StructField("loss", T.BooleanType(), False), T.StructField("state", T.StringType(), False),
        T.StructField("ok", T.BooleanType(), False),
    ])


def format_chat(
    turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Segments ``conv_id, turn_no, segment, text, loss, state, ok`` of every conversation.

    Turns are ordered by turn, role and text, nulls first, and numbered from 0
    (``turn_no``).  A null role or text is empty; rows without conversation id
    form one conversation; rows that repeat are turns of their own.  ``ok``:
    the machine allows the turn here.  All turns are written, also those that
    it does not allow.  Only the four named columns are read.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = _segment_schema(rows.schema["conv_id"].dataType)

    def run(batches):
        last, state, no = object(), "start", 0
        for batch in batches:
            for part in pieces(batch, 3):
                out: list[list] = [[] for _ in schema]
                kind = part.schema.field(0).type
                for conv, role, text in zip(*(part.column(i).to_pylist() for i in (0, 2, 3))):
                    if conv != last:
                        last, state, no = conv, "start", 0
                    state, ok = template.step(state, role)
                    for i, (string, loss) in enumerate(template.segments(role, text)):
                        for column, value in zip(out, (conv, no, i, string, loss, state, ok)):
                            column.append(value)
                    no += 1
                types = [kind, pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=schema.names)

    return dealt.mapInArrow(run, schema)


class _Reader:
    """Reads one conversation back from its segments, in order."""

    def __init__(self, conv, template: Template, parser: re.Pattern):
        self.conv, self.template, self.parser = conv, template, parser
        self.names = list(template.roles)
        self.closes = tuple({t.close for t in template.roles.values()} | {template.other.close})
        self.turns, self.turn_hash = 0, hashlib.sha256()
        self.loss, self.loss_hash = 0, hashlib.sha256()
        self.chars, self.wrong, self.end = 0, 0, "start"
        self.buffer: list[str] = []

    def take(self, no: int, text: str, loss: bool, state: str, ok: bool) -> None:
        self.chars += len(text)
        if loss:
            plain = self.template.unescape(text)
            self.loss += len(plain)
            self.loss_hash.update(plain.encode())
        self.buffer.append(text)
        if text.endswith(self.closes):
            self.parse()
            self.end, self.wrong = state, self.wrong + (not ok)

    def parse(self) -> None:
        formatted, at = "".join(self.buffer), 0
        while m := self.parser.match(formatted, at):
            at = m.end()
            name, text = m["name"], m["text"]
            if name is None:
                i = next(i for i in range(len(self.names)) if m[f"r{i}"] is not None)
                name, text = self.names[i], m[f"r{i}"]
            else:
                name = self.template.unescape(name)
            self.turns += 1
            self.turn_hash.update(f"{name}\n{self.template.unescape(text)}\n".encode())
        self.buffer = [formatted[at:]] if at < len(formatted) else []

    def row(self) -> tuple:
        if self.buffer:
            raise ValueError(f"conversation {self.conv}: its formatted text does not end with a whole turn")
        return (self.conv, self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars,
                self.wrong == 0 and self.end in self.template.ends, self.wrong)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """A row for each conversation, from the text and the loss flags of its segments.

    ``segments`` must come as :func:`format_chat` gives them (a conversation's
    segments together and in order, which a following map keeps).  ``valid``:
    the machine allows every turn and ends in an end state.
    """
    schema = T.StructType([
        T.StructField("conv_id", segments.schema["conv_id"].dataType),
        T.StructField("n_turns", T.LongType(), False), T.StructField("turns_sha256", T.StringType(), False),
        T.StructField("loss_chars", T.LongType(), False), T.StructField("loss_sha256", T.StringType(), False),
        T.StructField("formatted_chars", T.LongType(), False), T.StructField("valid", T.BooleanType(), False),
        T.StructField("n_wrong_turns", T.LongType(), False),
    ])

    def run(batches):
        parser, reader = template.parser(), None
        kind = None

        def batch_of(rows):
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for conv, no, _, text, loss, state, ok in zip(*(c.to_pylist() for c in batch.columns)):
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv, template, parser)
                reader.take(no, text, loss, state, ok)
            if done:
                yield batch_of(done)
        if reader is not None:
            yield batch_of([reader.row()])

    return segments.mapInArrow(run, schema)

r"""Chat formatting that is proven by a grammar round trip.

A turn is rendered as ``<|im_start|>ROLE\nTEXT<|im_end|>\n``.  Then the rendered text is parsed again by a deterministic
parser and compared to the source; conflicting content is escaped until the two are identical:

level 0: text as it is; level 1: a backslash after the ``<`` of each control string; level 2: one more backslash in
each ``<\...|``.  The parser always takes one backslash out of each ``<\...|``, so level 2 always holds.  In a role a
line feed becomes ``<|nl|>``.

Edge cases: null role and null text are empty; turns are ordered by turn (null first), then role, then text, so ties and
repeated rows have one defined order and every one of them is a turn; a null id is a conversation of its own.  Rows of
one conversation pass through one task in order, since its digests run over them in order, but they are streamed there
from sorted partitions, so a conversation of any size takes the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

# Fixed values of the template.
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
_CONTROL = re.compile(r"<(\|(?:im_start|im_end|nl)\|>)")
_ANY, _ESCAPED = re.compile(r"<(\\*\|)"), re.compile(r"<\\(\\*\|)")


def escape(text: str, level: int) -> str:
    return text if not level else (_CONTROL if level == 1 else _ANY).sub(r"<\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def parse(buffer: str) -> tuple[list[tuple[str, str]], str]:
    """Turns that the text begins with, and what is left of it, the begin of a turn that has not ended."""
    turns, at = [], 0
    while buffer.startswith(START, at):
        line = buffer.find("\n", at)
        end = buffer.find(END + "\n", line + 1)
        if line < 0 or end < 0:
            break
        role, text = buffer[at + len(START) : line], buffer[line + 1 : end]
        if START in text or END in text or START in role or END in role:
            raise ValueError("a control string inside a turn")
        turns.append((unescape(role.replace(NEWLINE, "\n")), unescape(text)))
        at = end + len(END) + 1
    return turns, buffer[at:]


def render(role: str, text: str) -> tuple[str, int, int, int]:
    """The rendered turn, its level of escaping, and where its text begins and ends in it."""
    for level in (0, 1, 2):
        head = START + escape(role, level).replace("\n", NEWLINE) + "\n"
        body = escape(text, level)
        turn = head + body + END + "\n"
        try:
            if parse(turn) == ([(role, text)], ""):
                return turn, level, len(head), len(head) + len(body)
        except ValueError:
            pass
    raise AssertionError("the last level of escaping can always be read back")


def render_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, rendered, escape_level, and the loss span [loss_begin, loss_end) in rendered.

    The rendered turns of a conversation in order, joined by nothing, are its formatted text.  The loss span covers the
    text of assistant turns and is empty for others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.parts(batch, 3):
                roles = part.column(2).to_pylist()
                done = [render(r, t) for r, t in zip(roles, part.column(3).to_pylist(), strict=True)]
                spans = [(b, e) if r == "assistant" else (0, 0) for r, (_, _, b, e) in zip(roles, done, strict=True)]
                more = [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int32())]
                more += [pa.array([x[k] for x in spans], pa.int64()) for k in (0, 1)]
                yield pa.record_batch([*part.columns, *more], names)

    rows = conversations.select("conv_id", "turn", shared.text_or_empty("role").alias("role"), shared.text_or_empty("text").alias("text"))
    names = ["conv_id", "turn", "role", "text", "rendered", "escape_level", "loss_begin", "loss_end"]
    kinds = [rows.schema[c].dataType.simpleString() for c in names[:4]]
    return rows.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, [*kinds, "string", "int", "bigint", "bigint"], strict=True)))


class _Reader:
    """Reads one conversation back from its rendered turns, piece by piece."""

    def __init__(self) -> None:
        self.turns, self.loss, self.source = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.rows = 0
        self.rest = ""

    def add(self, role: str, text: str, piece: str, begin: int, end: int) -> None:
        found, self.rest = parse(self.rest + piece)
        for r, t in found:
            self.turns.update(f"{r}\n{t}\n".encode())
        self.source.update(f"{role}\n{text}\n".encode())
        masked = unescape(piece[begin:end])
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.chars += len(piece)
        self.n += len(found)
        self.rows += 1

    def row(self, conv_id) -> tuple:
        if self.rest or self.n != self.rows or self.turns.digest() != self.source.digest():
            raise ValueError(f"conversation {conv_id} cannot be read back")
        return conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse the formatted text of every conversation, check it against the source, and give its digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        schema, reader, now, rows = None, None, None, []
        for batch in batches:
            schema = pa.schema([pa.field("conv_id", batch.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for part in shared.parts(batch, 3):
                for conv_id, *turn in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if reader is None or conv_id != now:
                        rows += [reader.row(now)] if reader else []
                        reader, now = _Reader(), conv_id
                    reader.add(*turn)
            if len(rows) >= 1000:
                yield out(rows)
                rows = []
        if reader:
            yield out([*rows, reader.row(now)])

    n = shared.partitions(rendered.sparkSession)
    ordered = rendered.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = ordered.select("conv_id", "role", "text", "rendered", "loss_begin", "loss_end")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def formatted_text(rendered: DataFrame) -> DataFrame:
    """Formatted text and its turns as rows for writing: conv_id, turn_no (from 1) and rendered, in order."""
    from pyspark.sql import Window

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rendered.select("conv_id", F.row_number().over(order).alias("turn_no"), "rendered", "loss_begin", "loss_end")

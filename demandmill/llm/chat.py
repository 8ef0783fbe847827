"""Chat formatting: turns become marked text segments with a loss flag each.

A ``Template`` declares the markers, the order of roles and the roles that are trained on. Roles drive
a finite-state machine whose state is the last role: a row is ``in_order`` if its role may follow, and a
row that may not does not stop the machine. Every turn gives three segments, its opening marker, its
text and its closing marker; only the text of a trained role carries the loss flag.

Inside texts and roles an escape character is put before every place where a marker or the escape
character itself begins, so the output can be read back exactly (``read_turn``).

Rows are dealt by conversation, sorted by turn and streamed: a conversation of any length is never held
in memory, a task keeps the last role only. Null text counts as empty, as does a null role (which no
order allows). Rows that share a turn go by role, then text; a null turn comes last. A null ``conv_id``
is a conversation. Other columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandmill.llm.common import map_arrow

START = ""


@dataclass(frozen=True)
class Template:
    """Markers, order and loss of a chat format."""

    mark: str = "###"
    name_end: str = ": "
    close: str = "</turn>"
    after: str = "\n"
    escape: str = "\\"
    #: Roles that may come after a role; ``START`` stands for none.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    trained: tuple[str, ...] = ("assistant",)

    def _begins(self, *controls: str) -> re.Pattern:
        """Places where a control string or the escape character begins, overlapping ones too."""
        return re.compile("|".join(f"(?={re.escape(c)})" for c in (*controls, self.escape)))

    def escaped(self, text: str) -> str:
        return self._begins(self.mark, self.close).sub(lambda m: self.escape, text)

    def escaped_role(self, role: str) -> str:
        return self._begins(self.mark, self.close, self.name_end[0]).sub(lambda m: self.escape, role)

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.DOTALL)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [
            (f"{self.mark} {self.escaped_role(role)}{self.name_end}", False),
            (self.escaped(text), role in self.trained),
            (self.close + self.after, False),
        ]

    def read_turn(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        skip = re.escape(self.escape) + "."
        body = re.compile(
            f"{re.escape(self.mark)} ((?:{skip}|(?!{re.escape(self.name_end)}).)*+)"
            f"{re.escape(self.name_end)}((?:{skip}|(?!{re.escape(self.close)})[^{re.escape(self.escape)}])*+)"
            f"{re.escape(self.close + self.after)}",
            re.DOTALL,
        )
        m = body.fullmatch(formatted)
        if not m:
            raise ValueError("not a turn of this template")
        return self.unescaped(m[1]), self.unescaped(m[2])


KEYS = ["conv_id", "turn", "role", "text"]
SEGMENT = "nth long, role string, in_order boolean, seg int, segment string, loss boolean"


def in_turns(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(*KEYS).na.fill("", ["role", "text"])
    return rows.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), "role", "text"
    )


def _formatted(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nth, state = object(), 0, START
        for batch in batches:
            at, rows = [], []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]
            for i, (conv, role, text) in enumerate(zip(*columns)):
                if conv != last:
                    last, nth, state = conv, 0, START
                in_order = role in template.follows.get(state, ())
                for seg, (segment, loss) in enumerate(template.segments(role, text)):
                    at.append(i)
                    rows.append((nth, role, in_order, seg, segment, loss))
                nth, state = nth + 1, role
            names = ["nth", "role", "in_order", "seg", "segment", "loss"]
            kinds = [pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.bool_()]
            made = [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)]
            conv = batch.column("conv_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([conv, *made], ["conv_id", *names])

    return run


def format_chats(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, nth, role, in_order, seg, segment, loss``: the segments of every turn.

    A conversation's formatted text is its segments by ``nth`` (from 0) and ``seg`` joined.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return map_arrow(
        in_turns(conversations), _formatted(template or Template()), f"conv_id {kind}, {SEGMENT}"
    )


def _read(template: Template):
    """Sums of one conversation after the other, from segments in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, parts = None, object(), []
        schema = None
        for batch in batches:
            schema = batch.schema.field("conv_id").type
            done = []
            names = ("conv_id", "in_order", "seg", "segment", "loss")
            for conv, in_order, seg, segment, loss in zip(*(batch.column(n).to_pylist() for n in names)):
                if conv != last:
                    if out:
                        done.append(_closed(out))
                    last, parts = conv, []
                    out = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                out[5] += len(segment)
                out[6] &= in_order
                if loss:
                    text = template.unescaped(segment)
                    out[3] += len(text)
                    out[4].update(text.encode())
                parts.append(segment)
                if seg == 2:
                    role, text = template.read_turn("".join(parts))
                    out[1] += 1
                    out[2].update(f"{role}\n{text}\n".encode())
                    parts = []
            if done:
                yield _batch(done, schema)
        if out:
            yield _batch([_closed(out)], schema)

    return run


def _closed(out: list) -> tuple:
    return out[0], out[1], out[2].hexdigest(), out[3], out[4].hexdigest(), out[5], out[6]


def _batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """A row per conversation, from its formatted segments alone: turns read back, text under the loss."""
    rows = segments.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "nth", "seg"
    )
    kind = segments.schema["conv_id"].dataType.simpleString()
    return map_arrow(
        rows, _read(template or Template()),
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, in_order boolean",
    )

"""Chat formatting by a finite-state machine over roles.

A template says how a turn of each role looks, which roles bear loss, and which role may
follow which. Its control strings are escaped inside texts, reversibly: in a text, each
backslash and each control string gets a backslash in front, and ``read_turns`` takes one
away again. So a text that imitates a marker stays a text.

Every turn becomes three segments: its opening marker, its escaped text, its closing mark.
Only the text of a role that bears loss carries the loss flag. The machine's state is the
last role; a turn that it does not allow, and a role that it does not know, are formatted
all the same and flagged, and the machine goes on from there.

Turns are ordered by number (null first), then role, then text; repeated rows are turns
of their own. Null texts and null roles are empty strings, a null conversation id is one
conversation. Formatting happens row by row before the rows of a conversation meet; the
sorted rows then pass through the machine one by one, so the longest conversation needs no
more memory than a short one. A table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

START = ""


@dataclass(frozen=True)
class Template:
    """Declares the markers, the loss-bearing roles and the allowed turn order."""

    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    opening: str = "### "
    colon: str = ": "
    closing: str = "</turn>"
    separator: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    last_roles: tuple[str, ...] = ("assistant",)

    @property
    def escaped(self) -> str:
        """Pattern of what is escaped inside texts and unknown roles."""
        return "|".join([r"\\", re.escape(self.opening.strip()), re.escape(self.closing), re.escape(self.colon)])


ESCAPE = "\\"


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, f"({template.escaped})", r"\\$1")


def unescape(text: str, template: Template) -> str:
    return re.sub(f"\\\\({template.escaped})", r"\1", text)


SEGMENT = "struct<text: string, loss: boolean>"
FORMATTED = f"conv long, position long, segments array<{SEGMENT}>, allowed boolean, last boolean"


def format_turns(turns: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, position, segments, allowed, last: one row per turn, the turns of a
    conversation together and in order within a partition."""
    template = template or Template()
    who = F.coalesce(F.col(role), F.lit(""))
    label = F.create_map(*[F.lit(x) for pair in template.labels.items() for x in pair])[who]
    marker = F.concat(F.lit(template.opening), F.coalesce(label, F.concat(F.lit("?"), escape(who, template))), F.lit(template.colon))
    bears = who.isin(*template.loss_roles)
    segments = F.array(
        F.struct(marker.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(F.coalesce(F.col(text), F.lit("")), template).alias("text"), bears.alias("loss")),
        F.struct(F.lit(template.closing + template.separator).alias("text"), F.lit(False).alias("loss")),
    )
    said = F.coalesce(F.col(text), F.lit("")).alias("said")
    rows = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"), said, segments.alias("segments"))
    order = ["conv", "turn", "role", "said"]
    ordered = rows.repartition("conv").sortWithinPartitions(*order).select("conv", "role", "segments")

    def machine(batches) -> Iterator[pa.RecordBatch]:
        held, state, conv, position = None, START, None, -1
        for batch in batches:
            convs, roles = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            numbers, allowed, last = [], [], []
            for key, who in zip(convs, roles, strict=True):
                if position < 0 or key != conv:
                    state, conv, position = START, key, -1
                position += 1
                numbers.append(position)
                allowed.append(who in template.follows.get(state, ()))
                last.append(False)
                state = who
            done = [batch.column(0), pa.array(numbers, pa.int64()), batch.column(2), pa.array(allowed, pa.bool_())]
            # whether a batch's last turn ends its conversation, the next batch tells
            ends = [a != b for a, b in zip(convs, convs[1:], strict=False)]
            if held:
                yield _closed(held, not convs or held[0][-1] != convs[0])
            held = (convs, done, ends)
        if held:
            yield _closed(held, True)

    def _closed(held, final: bool) -> pa.RecordBatch:
        _, columns, ends = held
        return pa.RecordBatch.from_arrays([*columns, pa.array([*ends, final], pa.bool_())], names=["conv", "position", "segments", "allowed", "last"])

    return ordered.mapInArrow(machine, FORMATTED)


class TurnReader:
    """Reads turns back from formatted text."""

    def __init__(self, template: Template):
        self.template = template
        self.roles = {label: role for role, label in template.labels.items()}
        self.mark = re.compile(f"\\\\(?:{template.escaped})|({re.escape(template.colon)})|({re.escape(template.closing + template.separator)})", re.S)

    def _until(self, text: str, at: int, group: int) -> tuple[str, int]:
        """The unescaped stretch up to the next mark of a kind, and the place after it."""
        start = at
        while found := self.mark.search(text, at):
            if found[group]:
                return unescape(text[start : found.start()], self.template), found.end()
            at = found.end()
        raise ValueError("a turn is not closed")

    def read(self, text: str, at: int = 0) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn."""
        opening = self.template.opening
        while at < len(text):
            if not text.startswith(opening, at):
                raise ValueError("a turn does not begin with its marker")
            label, at = self._until(text, at + len(opening), 1)
            body, at = self._until(text, at, 2)
            yield label[1:] if label.startswith("?") else self.roles[label], body


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, first_error long"


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of each conversation's turns and of the text under its loss mask, read from
    the formatted segments as they come."""
    template = template or Template()

    def run(batches) -> Iterator[pa.RecordBatch]:
        reader, fresh = TurnReader(template), True
        names = [x.split()[0] for x in DIGEST.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64()]
        for batch in batches:
            out = []
            for conv, position, segments, allowed, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if fresh:
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n = loss_chars = chars = 0
                    error, fresh = None, False
                for role, text in reader.read("".join(s["text"] for s in segments)):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                masked = unescape("".join(s["text"] for s in segments if s["loss"]), template)
                loss.update(masked.encode())
                loss_chars += len(masked)
                chars += sum(len(s["text"]) for s in segments)
                if not allowed and error is None:
                    error = position
                if last:
                    final = role in template.last_roles
                    out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, error is None and final, error))
                    fresh = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return formatted.select("conv", "position", "segments", "allowed", "last").mapInArrow(run, DIGEST)

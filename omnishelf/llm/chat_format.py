"""Chat formatting by a declarative template and a finite-state machine over roles.

The template says which literal and field segments a turn becomes and for which roles a segment
counts towards the loss; the machine says which role may follow which. Conversations are dealt by id,
sorted by turn, and run through the machine as a stream, so a task holds one turn at a time however
long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import ready, stored

START, BROKEN = "start", "broken"


@dataclass(frozen=True)
class Segment:
    """A piece of a turn: a literal, or the turn's ``role`` or ``text``."""

    literal: str = ""
    value: str = ""
    loss_roles: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Template:
    """What a turn is written as, and which roles may follow each other.

    ``follows`` maps a state (``start`` or the last role) to the roles that may come next;
    ``final`` holds the states a conversation may end in. Literals keep to ``<|name|>`` and line
    feeds, so that escaped fields can never be taken for them.
    """

    segments: tuple[Segment, ...]
    follows: Mapping[str, frozenset[str]]
    final: frozenset[str] = field(default_factory=frozenset)

    def pattern(self) -> re.Pattern:
        """What one written turn looks like, with its role and text as groups."""
        group = {"role": r"(?P<role>[^\n]*)", "text": r"(?P<text>.*)"}
        parts = [group[s.value] if s.value else re.escape(s.literal) for s in self.segments]
        return re.compile("".join(parts), re.DOTALL)


# The marks of the widespread im_start format.
IM_TEMPLATE = Template(
    segments=(
        Segment("<|im_start|>"),
        Segment(value="role"),
        Segment("\n"),
        Segment(value="text", loss_roles=frozenset({"assistant"})),
        Segment("<|im_end|>\n"),
    ),
    follows={
        START: frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    },
    final=frozenset({START, "assistant"}),
)

_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE = {"\\": "\\\\", "\n": "\\n", "<": "\\l"}
_ROLE_BACK = {v: k for k, v in _ROLE.items()}


def escape(text: str) -> str:
    """No ``<|`` is left: every ``<``, backslashes, ``|`` gets one backslash more."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """One line without ``<``."""
    return re.sub(r"[\\\n<]", lambda m: _ROLE[m.group()], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\[\\nl]", lambda m: _ROLE_BACK[m.group()], role)


def write_turn(template: Template, role: str, text: str) -> tuple[str, list[dict]]:
    """The written turn and its segments as (start, length, loss), in code points."""
    out, segments, at = [], [], 0
    for s in template.segments:
        if s.value == "role":
            piece = escape_role(role)
        else:
            piece = escape(text) if s.value == "text" else s.literal
        segments.append({"start": at, "length": len(piece), "loss": role in s.loss_roles})
        out.append(piece)
        at += len(piece)
    return "".join(out), segments


_SEGMENTS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("loss", pa.bool_())]))
_WRITTEN = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("state", pa.string()), ("valid", pa.bool_()),
    ("formatted", pa.string()), ("segments", _SEGMENTS),
])
WRITTEN = (
    "conv_id long, place long, state string, valid boolean, formatted string, "
    "segments array<struct<start:long,length:long,loss:boolean>>"
)
READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean, first_invalid long"
)


def _by_conversation(turns: DataFrame, order: list) -> DataFrame:
    """All rows of a conversation one after the other in one task, in the given order."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(turns: DataFrame, template: Template = IM_TEMPLATE) -> DataFrame:
    """One row per turn: its written form, its segments with loss flags and the machine's verdict.

    ``state`` is the machine's state after the turn: its role, or ``broken`` from the first role on
    that may not stand where it does; ``valid`` is false from there on. Broken conversations are
    written out all the same, for the caller to drop or keep. A null text or role is empty; rows
    without a turn come first, and equal turns go by role and text, so that ties and repeated rows
    have one order. Rows without a conv_id form one conversation. Of other columns nothing is read;
    an empty table gives an empty table.
    """

    def write(batches: Iterator[pa.RecordBatch]):
        known, last, place, state = False, None, 0, START
        for batch in batches:
            out = []
            conversations, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            for conv, role, text in zip(conversations, roles, texts, strict=True):
                if not known or conv != last:
                    known, last, place, state = True, conv, 0, START
                state = role if role in template.follows.get(state, ()) else BROKEN
                formatted, segments = write_turn(template, role, text)
                out.append((conv, place, state, state != BROKEN, formatted, segments))
                place += 1
            columns = zip(*out, strict=True) if out else [[]] * len(_WRITTEN)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _WRITTEN, strict=True)],
                schema=_WRITTEN,
            )

    ready(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = _by_conversation(rows, [F.asc_nulls_first("turn"), "role", "text"])
    return ordered.select("conv_id", "role", "text").mapInArrow(write, WRITTEN)


def read_conversations(written: DataFrame, template: Template = IM_TEMPLATE) -> DataFrame:
    """Turns and loss of each conversation, parsed from the written form alone.

    Every row's text is matched against the template, its fields are unescaped, and the loss is what
    the segments' flags cover, unescaped. Digests are fed turn by turn. A row that the template did
    not write fails the job. ``valid`` holds where no turn is out of order and the last state may
    end a conversation, ``first_invalid`` is the place of the first turn out of order.
    """
    pattern = template.pattern()

    def read(batches: Iterator[pa.RecordBatch]):
        def result():
            ended = broken is None and state in template.final
            return (last, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, ended, broken)

        known, last = False, None
        for batch in batches:
            out = []
            cells = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for conv, place, state_now, valid, text, segments in cells:
                if not known or conv != last:
                    if known:
                        out.append(result())
                    known, last, n, chars, loss_chars, broken = True, conv, 0, 0, 0, None
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                turn = pattern.fullmatch(text)
                if turn is None or "<|" in turn["text"]:
                    raise ValueError(f"conversation {conv}, place {place}: not written by this template")
                role = unescape_role(turn["role"])
                turns.update(f"{role}\n{unescape(turn['text'])}\n".encode())
                for s in segments:
                    if s["loss"]:
                        learned = unescape(text[s["start"] : s["start"] + s["length"]])
                        loss_chars += len(learned)
                        loss.update(learned.encode())
                n += 1
                chars += len(text)
                state = state_now
                if not valid and broken is None:
                    broken = place
            yield _digests(out)
        if known:
            yield _digests([result()])

    return _by_conversation(written, ["place"]).mapInArrow(read, READ)


_READ = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
         ("valid", pa.bool_()), ("first_invalid", pa.int64())]


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_READ)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, (_, kind) in zip(columns, _READ, strict=True)],
        [name for name, _ in _READ],
    )


def written_and_read(turns: DataFrame, template: Template = IM_TEMPLATE) -> DataFrame:
    """Write the formatted conversations to the shared folder and digest them from there."""
    return read_conversations(stored(format_conversations(turns, template)), template)

r"""Chat formatting with a grammar round trip.

A turn is written as

    ### <role>\n<text>\n</turn>\n

`###` and `</turn>` are control strings. A control string inside a text carries
one backslash more than it had, so a run of n >= 1 backslashes before one reads
back as n - 1 backslashes and the string itself; a bare one is control. Every
turn is rendered plainly first and read back with the parser; only when the
recovered turn differs from its source is the conflicting content escaped, and
the check repeated until both are identical.

Defined cases: null text and null role are empty; turns of a conversation are
ordered by (turn, role, text) with nulls first, so repeated and tied rows are
all kept in a fixed order; rows without a conversation id form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

HEADER, END = "### ", "\n</turn>\n"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_ESCAPED = re.compile(r"(\\+)(###|</turn>)")
LEARNED_ROLE = "assistant"

SEGMENTS = "conv_id long, turn long, role string, text string, segment string, loss_start int, loss_end int"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long"
)


class GrammarError(ValueError):
    """The text is not a rendered turn."""


def _role_line(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line)


def parse_turn(segment: str) -> tuple[str, str, int, int]:
    """(role, text, start and end of the written text) of one rendered turn.

    Deterministic: the first bare control string must be the end mark, and
    nothing may follow it.
    """
    if not segment.startswith(HEADER):
        raise GrammarError("no header")
    stop = segment.find("\n")
    if stop < 0:
        raise GrammarError("no role line")
    start = stop + 1
    for found in _CONTROL.finditer(segment, start):
        if found[1]:
            continue
        at = found.start() - 1
        if found[2] != "</turn>" or at < start or segment[at:] != END:
            raise GrammarError("control string inside a text")
        return _role_of(segment[len(HEADER) : stop]), unescape(segment[start:at]), start, at
    raise GrammarError("no end mark")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1][1:] + m[2], text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and the place of its written text, checked by reading it back."""
    written = text
    while True:
        segment = f"{HEADER}{_role_line(role)}\n{written}{END}"
        try:
            found = parse_turn(segment)
        except GrammarError:
            found = None
        if found and found[:2] == (role, text):
            return segment, found[2], found[3]
        if written is not text:
            raise GrammarError("escaping did not recover the turn")
        written = escape(text)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles = [x or "" for x in batch.column("role").to_pylist()]
        texts = [x or "" for x in batch.column("text").to_pylist()]
        done = [render_turn(r, t) for r, t in zip(roles, texts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                pa.array(roles, pa.string()),
                pa.array(texts, pa.string()),
                pa.array([d[0] for d in done], pa.string()),
                pa.array([d[1] if r == LEARNED_ROLE else None for d, r in zip(done, roles, strict=True)], pa.int32()),
                pa.array([d[2] if r == LEARNED_ROLE else None for d, r in zip(done, roles, strict=True)], pa.int32()),
            ],
            names=["conv_id", "turn", "role", "text", "segment", "loss_start", "loss_end"],
        )


def format_turns(turns: DataFrame) -> DataFrame:
    """One rendered segment per turn; a conversation is its segments in order.

    `loss_start` and `loss_end` are code points within the segment and null
    outside assistant turns. Segments stay apart, so that a conversation of any
    length never becomes one value.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(_render, SEGMENTS)


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start, end) -> None:
        role, text, _, _ = parse_turn(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            learned = unescape(segment[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by conversation; only running digests are held."""
    names = [part.split()[0] for part in DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def out(rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    held = None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")]
        for conv_id, segment, start, end in zip(*columns, strict=True):
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    done.append(held.row())
                held = _Digest(conv_id)
            held.add(segment, start, end)
        if done:
            yield out(done)
    if held is not None:
        yield out([held.row()])


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, what its rendered segments hold.

    The rows of a conversation pass through one task in order, a batch at a
    time, because a digest is a running value; rendering, escaping and the
    round trip happen before, on every executor.
    """
    return (
        segments.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "segment", "loss_start", "loss_end")
        .mapInArrow(_digest, DIGESTS)
    )

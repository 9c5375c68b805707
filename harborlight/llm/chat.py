"""Chat formatting with a grammar round trip.

The template writes one piece per turn:

    system     <<SYS>>\\n text \\n<</SYS>>\\n\\n
    user       <s>[INST] text [/INST]
    assistant  (space) text (space) </s>
    other      [ROLE name] text [/ROLE]

A deterministic parser reads pieces back.  Each turn is first rendered as it is; if the
parser does not recover exactly that turn, every control string inside its text is
escaped by a backslash after its first character (one more, where there are some), which
the parser removes again; role names outside the three known ones are percent-encoded.  Rendering is per turn, so a conversation of any length
is formatted by many tasks; only the digests of a conversation, which are sequential by
definition, stream its rows in order through one task without holding them.

Turn order: by ``turn`` (null last), then role, then text.  Defined cases: null text or
role is the empty string; repeated rows are separate turns; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<<SYS>>", "<</SYS>>", "<s>", "</s>", "[INST]", "[/INST]", "[ROLE ", "[/ROLE]")
_RAW = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile(
    "|".join(f"{re.escape(c[0])}\\\\+{re.escape(c[1:])}" for c in CONTROL)
)
_FRAMES = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
}
_OTHER = ("[ROLE ", "] ", " [/ROLE]")
TURNS = (
    "conv_id long, turn long, role string, text string, piece string, n_chars long,"
    " is_escaped boolean"
)
_TURN_NAMES = [f.split()[0] for f in TURNS.split(", ")]
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def escape(text: str) -> str:
    return _RAW.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def _write(role: str, text: str) -> str:
    if role in _FRAMES:
        before, after = _FRAMES[role]
        return before + text + after
    return f"{_OTHER[0]}{quote(role, safe='')}{_OTHER[1]}{text}{_OTHER[2]}"


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation; raises ValueError where the grammar is broken."""
    turns, at = [], 0
    while at < len(formatted):
        for role, (before, after) in _FRAMES.items():
            if formatted.startswith(before, at):
                start = at + len(before)
                break
        else:
            if not formatted.startswith(_OTHER[0], at):
                raise ValueError(f"no turn begins at {at}")
            stop = formatted.find(_OTHER[1], at)
            if stop < 0:
                raise ValueError(f"role at {at} has no end")
            role = unquote(formatted[at + len(_OTHER[0]) : stop])
            start, after = stop + len(_OTHER[1]), _OTHER[2]
        end = formatted.find(after, start)
        if end < 0:
            raise ValueError(f"turn at {at} has no end")
        turns.append((role, unescape(formatted[start:end])))
        at = end + len(after)
    return turns


def render(role: str, text: str) -> tuple[str, bool]:
    """The piece of one turn, and whether its content had to be escaped."""
    plain = _write(role, text)
    if not _RAW.search(text):
        try:
            if parse(plain) == [(role, text)]:
                return plain, False
        except ValueError:
            pass
    escaped = _write(role, escape(text))
    if parse(escaped) != [(role, text)]:
        raise ValueError(f"turn cannot be written reversibly: {role!r}")
    return escaped, True


def format_turns(
    turns: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One formatted ``piece`` per turn, with the number of its characters."""
    rows = turns.select(
        F.col(id_column).cast("long").alias("conv_id"),
        F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = (batch.column(i).to_pylist() for i in (2, 3))
            made = [render(r, t) for r, t in zip(roles, texts, strict=True)]
            arrays = [
                *(batch.column(i) for i in range(4)),
                pa.array([piece for piece, _ in made], pa.string()),
                pa.array([len(piece) for piece, _ in made], pa.int64()),
                pa.array([escaped for _, escaped in made], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=_TURN_NAMES)

    return rows.mapInArrow(write, TURNS)


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str) -> None:
        self.chars += len(piece)
        for role, text in parse(piece):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars,
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Digest | None = None
    for batch in batches:
        done = []
        for conv_id, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Digest(conv_id)
            current.add(piece)
        if done:
            yield _rows(done)
    if current is not None:
        yield _rows([current.row()])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in DIGESTS.split(", ")])


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """Per conversation: turns, loss mask and lengths, parsed back from its pieces."""
    ordered = pieces.repartition(F.col("conv_id")).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), "role", "text"
    )
    return ordered.select("conv_id", "piece").mapInArrow(_digest, DIGESTS)

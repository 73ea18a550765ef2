"""Chat formatting with a grammar round trip.

Grammar, one production per turn, so that a conversation is parsed turn by turn and may be of any length::

    conversation := turn*
    turn         := "### " role ": " body "</turn>" "\\n"

A backslash makes the next character literal in role and body. Rendering starts with the plain text. The rendered turn is
parsed again, and as long as the parse differs from the source, or a turn's opening or close stands bare in role or body, one more
control string is escaped in it. Turns end where they end whatever follows, so what holds for each holds for the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, SEP, CLOSE = "### ", ": ", "</turn>"
#: Control strings in the order in which they get escaped; the backslash comes first, as the others add some.
CONTROL = ("\\", CLOSE, OPEN, SEP)
RENDERED = "conv_id long, turn long, role string, rendered string, body_start long, body_end long, rounds int"


def escape(text: str, level: int) -> str:
    """``text`` with a backslash before every one of the first ``level`` control strings."""
    if not level:
        return text
    return re.sub("|".join(re.escape(c) for c in CONTROL[:level]), lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _find(text: str, what: str, start: int) -> int:
    """Where ``what`` stands unescaped at or after ``start``; -1 if nowhere."""
    for m in re.compile(r"\\.|" + re.escape(what), re.S).finditer(text, start):
        if m[0] == what:
            return m.start()
    return -1


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, body's start, body's end) of each turn of a rendered conversation; ValueError if it isn't one."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        mid = _find(text, SEP, at + len(OPEN))
        end = _find(text, CLOSE, mid + len(SEP)) if mid >= 0 else -1
        if end < 0 or text[end + len(CLOSE) : end + len(CLOSE) + 1] != "\n":
            raise ValueError(f"a turn that doesn't end, at {at}")
        start = mid + len(SEP)
        turns.append((unescape(text[at + len(OPEN) : mid]), unescape(text[start:end]), start, end))
        at = end + len(CLOSE) + 1
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """(rendered turn, body's start, body's end, rounds of escaping) such that parse() gives role and text back."""
    for level in range(len(CONTROL) + 1):
        head = OPEN + escape(role, level) + SEP
        body = escape(text, level)
        out = head + body + CLOSE + "\n"
        bare = any(_find(part, mark, 0) >= 0 for part in (head[len(OPEN) :], body) for mark in (OPEN, CLOSE))
        try:
            if not bare and [t[:2] for t in parse(out)] == [(role, text)]:
                return out, len(head), len(head) + len(body), level
        except ValueError:
            pass
    raise AssertionError("a fully escaped turn parses to itself")


def _render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        made = [render_turn(r, t) for r, t in zip(f["role"], f["text"], strict=True)]
        yield pd.DataFrame({"conv_id": f["conv_id"], "turn": f["turn"], "role": f["role"]} | {c: [m[i] for m in made] for i, c in enumerate(("rendered", "body_start", "body_end", "rounds"))})


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, role, rendered, body_start, body_end (code points in ``rendered``), rounds.

    A conversation is its rendered turns joined in the order of (turn, rendered); the grammar needs nothing between them.
    The loss mask covers the bodies of the assistant's turns. Null text or role: empty. Null conv_id: one conversation of its
    own. Null turn: first. Repeated rows are repeated turns. An empty table gives no rows; further columns are left out.
    Rows are rendered where they lie, so a conversation of any share of the rows needs no shuffle here.
    """
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # pandas turns longs with nulls into doubles; Arrow's nullable integers come back as they were
    return rows.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text").mapInPandas(_render, RENDERED.replace("conv_id long, turn long", "conv_id string, turn string")).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "rendered", "body_start", "body_end", "rounds")


class _Digest:
    """Running digests of one conversation, read back from rendered turns."""

    def __init__(self, conv_id: int | None, loss_role: str):
        self.conv_id, self.loss_role, self.turns, self.loss, self.chars = conv_id, loss_role, 0, 0, 0
        self.all, self.said = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str) -> None:
        """Of one turn, or of several in a row."""
        self.chars += len(rendered)
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == self.loss_role:
                self.loss += len(text)
                self.said.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.said.hexdigest(), self.chars


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digest(batches: Iterator[pa.RecordBatch], loss_role: str) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for b in batches:
        for conv_id, rendered in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if now is None or now.conv_id != conv_id:
                done += [now.row()] if now else []
                now = _Digest(conv_id, loss_role)
            now.add(rendered)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(_DIGESTS.names, r, strict=True)) for r in done], schema=_DIGESTS)
            done = []
    done += [now.row()] if now else []
    yield pa.RecordBatch.from_pylist([dict(zip(_DIGESTS.names, r, strict=True)) for r in done], schema=_DIGESTS)


def digests(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Per conversation, read back from format_turns(): turns, loss text and sizes. Turns stream through, sorted, so that
    memory holds one batch whatever the conversation's length."""
    rows = formatted.select("conv_id", "rendered", "turn").repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "rendered")
    return rows.select("conv_id", "rendered").mapInArrow(lambda it: _digest(it, loss_role), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

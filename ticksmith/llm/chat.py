"""Chat formatting from an event log.

A log row is (conv, seq, event, turn, role, text).  ``message`` opens a turn, ``delta``
appends to its turn (streamed output), ``edit`` replaces a turn and drops all later ones,
``regenerate`` drops its turn and all later ones and opens it anew (its text may be empty, to
be streamed).  An event counts unless a later edit or regenerate of its conversation names
the same or an earlier turn; what counts is folded per turn in order.  The log is partitioned
by conversation and sorted by sequence; a running minimum over the later events finds what
counts, and the fold and the rendering run over the sorted rows as a stream, holding one turn
at a time.  So a conversation with a third of all rows needs no more memory than another one.

``render`` gives one row per turn, a segment of the formatted conversation; the formatted
conversation is its segments in order.  A segment is ``<|im_start|>role\\ntext<|im_end|>\\n``.
Inside roles and texts every ``<`` + backslashes + ``|`` gets one more backslash, so no
control string stands there and ``unescape`` restores them; in roles backslashes and line ends
are escaped first.  ``mask_start``, ``mask_end`` give the code points of the segment under
the loss mask: the text of assistant turns (escaped, as it stands).

``read_back`` parses the segments again, as a stream over the joined text, and gives one row
per conversation.

Defined results: a null text or role is empty; a null conversation is one of its own; null
turns come first, null sequence numbers too; ties in sequence go by turn, event, role and text;
repeated rows count each; a delta without a turn opens one; an unknown event counts as a message;
an empty log gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_REWINDS = ["edit", "regenerate"]
_RAW, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
SEGMENTS = "conv_id long, segment long, formatted string, mask_start long, mask_end long"
TURNS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_loss_turns long")


def escape(text: str) -> str:
    return _RAW.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def log_of_messages(messages: DataFrame) -> DataFrame:
    """The log of a table (conv_id, turn, role, text) of finished messages."""
    return messages.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("seq"), F.lit("message").alias("event"),
        F.col("turn").cast("long").alias("turn"), "role", "text")


def fold(log: DataFrame) -> DataFrame:
    """The events that count, without text joined: the log less what a later rewind has dropped."""
    order = [F.col(c) for c in ("seq", "turn", "event", "role", "text")]
    later = Window.partitionBy("conv").orderBy(*[c.desc_nulls_last() for c in order]).rowsBetween(
        Window.unboundedPreceding, -1)
    cut = F.min(F.when(F.col("event").isin(*_REWINDS), F.coalesce(F.col("turn"), F.lit(-(2**63))))).over(later)
    alive = log.select("conv", *order, cut.alias("cut"))
    return alive.filter(F.col("cut").isNull() | (F.col("turn") < F.col("cut"))).drop("cut")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, str))
        if size > limit or len(held) >= 10000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _segments(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Fold deltas into turns and render each, over rows sorted by conversation and sequence."""
    conv, open_turn, n = object(), None, 0
    role, parts = "", []

    def rendered() -> tuple:
        head, body = f"{START}{escape_role(role)}\n", escape("".join(parts))
        masked = role == "assistant"
        return (conv, n, f"{head}{body}{END}\n", len(head) if masked else None, len(head) + len(body) if masked else None)

    for c, event, turn, r, text in rows:
        if c != conv or not (event == "delta" and turn == open_turn):
            if parts:
                yield rendered()
                n += 1
            if c != conv:
                conv, n = c, 0
            open_turn, role, parts = turn, r or "", []
        parts.append(text or "")
    if parts:
        yield rendered()


def render(log: DataFrame) -> DataFrame:
    """(conv_id, segment, formatted, mask_start, mask_end): a row per turn, in order within its conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_segments(_rows(batches)), _schema(SEGMENTS))

    order = ["conv", "seq", "turn", "event", "role", "text"]
    rows = fold(log).sortWithinPartitions(*order).select("conv", "event", "turn", "role", "text")
    return rows.mapInArrow(run, SEGMENTS)


def _parsed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row per conversation from its segments in order, digests taken as they stream by."""
    conv, acc = object(), None

    def closed() -> tuple:
        return (conv, acc["turns"], acc["sha"].hexdigest(), acc["chars"], acc["loss"].hexdigest(), acc["all"], acc["masked"])

    for c, formatted, start, end in rows:
        if c != conv or acc is None:
            if acc:
                yield closed()
            conv = c
            acc = {"turns": 0, "sha": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0, "masked": 0}
        acc["all"] += len(formatted)
        for turn in formatted.split(f"{END}\n")[:-1]:
            role, text = turn.removeprefix(START).split("\n", 1)
            role, text = unescape_role(role), unescape(text)
            acc["turns"] += 1
            acc["sha"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            loss = unescape(formatted[start:end])
            acc["masked"] += 1
            acc["chars"] += len(loss)
            acc["loss"].update(loss.encode("utf-8", "surrogatepass"))
    if acc:
        yield closed()


def read_back(segments: DataFrame, in_order: bool = False) -> DataFrame:
    """Per conversation, from the rendered segments alone: turns, digests and lengths.

    ``in_order``: the frame comes from ``render`` as it is, so the segments of a conversation
    follow each other in one partition and need no second shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_parsed(_rows(batches)), _schema(TURNS))

    rows = segments if in_order else segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return rows.select("conv_id", "formatted", "mask_start", "mask_end").mapInArrow(run, TURNS)

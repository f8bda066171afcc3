"""Flat JSON tick codec: message value <-> tick columns.

Parsing is ``from_json`` with a declared schema (PERMISSIVE): text that is not
JSON gives a struct of NULLs, a NULL value a NULL struct, an unparseable
timestamp a NULL timestamp, a text rate a NULL rate.  Nothing throws per row;
:func:`tag_ticks` names what is wrong with each message instead, and
:func:`ticksmith.operators.quality.split` turns the tag into
(good, quarantine).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.schema import TICK

# Message timestamps are written as ISO-8601 with milliseconds and a zone,
# e.g. 2023-03-08T09:17:42.000Z.
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
JSON_OPTIONS = {"timestampFormat": JSON_TS_FORMAT, "timeZone": "UTC"}

# Quarantine reasons for flat tick messages.
R_NULL = "null message"
R_NOT_OBJECT = "not a tick object"
R_NO_SYMBOL = "missing from/to"
R_NO_TIME = "missing or unparseable timestamp"
R_NO_RATE = "missing or non-numeric rate"


def is_number(value: Column) -> Column:
    """Whether a double is a finite number (JSON readers take a bare ``NaN`` or ``Infinity`` too)."""
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))


def is_blank(name: Column) -> Column:
    """Whether a symbol or currency is missing or empty."""
    return F.coalesce(F.trim(name) == "", F.lit(True))


def as_text(col: str | Column) -> Column:
    """Binary (or any) message value as a string: ``CAST(value AS STRING)``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def tick_json(
    from_col: str | Column = "from",
    to_col: str | Column = "to",
    ts_col: str | Column = "timestamp",
    rate_col: str | Column = "rate",
) -> Column:
    """``{"from":..,"to":..,"timestamp":..,"rate":..}`` as one JSON string.

    A TIMESTAMP event time is written with milliseconds in UTC; a string event
    time (the quote's ``last_updated``) is copied verbatim.
    """
    cols = [
        (F.col(c) if isinstance(c, str) else c).alias(n)
        for c, n in ((from_col, "from"), (to_col, "to"), (ts_col, "timestamp"), (rate_col, "rate"))
    ]
    return F.to_json(F.struct(*cols), JSON_OPTIONS)


def parse_tick(value: str | Column) -> Column:
    """The tick struct parsed from a message value (binary or string)."""
    return F.from_json(as_text(value), TICK, {"timeZone": "UTC"})


def fenced(parsed: Column) -> Column:
    """Emit ``parsed`` through a one-element generator.

    Catalyst pushes filters below projections by substituting the projected
    expressions, so a predicate over five fields of a ``from_json`` result
    would parse the text five more times per row.  Predicates cannot be pushed
    through a generator's output, so the parse runs exactly once per row.
    """
    return F.explode(F.array(parsed))


def tag_ticks(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse once into ``from, to, timestamp, rate`` plus ``_raw`` and ``_reason``.

    ``_reason`` is NULL for a usable tick.  A tick without an event time can
    never open a window, one without a rate would make a NULL mean; both are
    set aside instead of silently vanishing.
    """
    parsed = df.select(
        *[F.col(c) for c in keep],
        as_text(value_col).alias("_raw"),
        fenced(parse_tick(value_col)).alias("_t"),
    )
    t = F.col("_t")
    reason = (
        F.when(F.col("_raw").isNull(), F.lit(R_NULL))
        .when(
            t.isNull()
            | (
                t["from"].isNull()
                & t["to"].isNull()
                & t["timestamp"].isNull()
                & t["rate"].isNull()
            ),
            F.lit(R_NOT_OBJECT),
        )
        .when(is_blank(t["from"]) | is_blank(t["to"]), F.lit(R_NO_SYMBOL))
        .when(t["timestamp"].isNull(), F.lit(R_NO_TIME))
        .when(~is_number(t["rate"]), F.lit(R_NO_RATE))
    )
    return parsed.select(
        *[F.col(c) for c in keep],
        t["from"].alias("from"),
        t["to"].alias("to"),
        t["timestamp"].alias("timestamp"),
        t["rate"].alias("rate"),
        F.col("_raw"),
        reason.alias("_reason"),
    )


def parse_ticks(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Plain projection ``value -> data.* ``: every message, bad fields NULL."""
    return df.select(fenced(parse_tick(value_col)).alias("data")).select("data.*")

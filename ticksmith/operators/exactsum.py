"""Sums and means of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so the mean of a window changes in its last bits with the number of
files, tasks and batches its ticks came in.  Here a double is cut into five whole numbers, its
digits to the base 2**32 from 2**32 down to 2**-96, each of which is added up exactly as a long.  The
sums merge like any sum, in partial aggregates, in streaming state and in stored roll-ups, and are rounded
once, at the end: the result is the double nearest to the true sum.

A value at or beyond 2**62, infinite or not a number has no such digits: those are added as doubles beside
the others.  What lies below 2**-96 (1e-29) of a value is added as a double too.  Nothing is left out.

All is built-in expressions within code generation: five long sums in place of one double sum.  They are
written as SQL text, and finished in steps, as trees of hundreds of nodes cost more to plan than to run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 5
#: The columns of a stored sum.
PARTS = (*(f"sum_{i}" for i in range(DIGITS)), "sum_rest", "sum_beyond")
_BASE, _LIMIT = f"{2.0**32!r}D", f"{2.0**62!r}D"


def _power(n: int) -> str:
    return f"{2.0**n!r}D"


def parts(value: str) -> dict[str, Column]:
    """The aggregates that hold the sum of a column, by the names in PARTS."""
    value = f"`{value}`"
    inside = f"CASE WHEN abs({value}) < {_LIMIT} THEN {value} END"  # not a number is above all numbers
    rest = f"(({inside}) % {_BASE})"
    digits = [f"(({inside}) - {rest}) / {_BASE}"]
    for i in range(1, DIGITS):
        if i > 1:
            rest = f"({rest} * {_BASE})"
        digits.append(f"{rest} - {rest} % 1D")
        rest = f"({rest} % 1D)"
    beyond = f"CASE WHEN NOT abs({value}) < {_LIMIT} THEN {value} END"
    texts = [*(f"sum(CAST({d} AS BIGINT))" for d in digits), f"sum({rest})", f"sum({beyond})"]
    return {name: F.expr(text) for name, text in zip(PARTS, texts)}


def merged() -> dict[str, Column]:
    """The aggregates that add up stored sums."""
    return {name: F.sum(name) for name in PARTS}


def with_total(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the sum that their PARTS columns hold, rounded once, in place of them; 0 if they hold no value."""
    if name in rows.columns:
        raise ValueError(f"a column is named like the result: {name}")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in PARTS]
    # every digit but the first from 0 to 2**32 - 1
    carried, texts = [f"coalesce(sum_{i}, 0L)" for i in range(DIGITS)], []
    for i in range(DIGITS - 1, 0, -1):
        texts.append(f"{carried[i]} & 4294967295L AS __d{i}")
        carried[i - 1] = f"({carried[i - 1]} + shiftright({carried[i]}, 32))"
    rows = rows.select(*kept, F.expr(f"{carried[0]} AS __d0"), *map(F.expr, texts), "sum_rest", "sum_beyond")
    rows = rows.select(*kept, *[f"__d{i}" for i in range(DIGITS)], "sum_rest", "sum_beyond", F.expr(
        "CASE WHEN abs(__d0) < 2 THEN __d0 * 4294967296L + __d1 END AS __whole"))

    def number(upto: int) -> str:
        found = "CAST(__d0 AS DECIMAL(20, 0))"
        for i in range(1, upto):
            found = f"CAST({found} * CAST(4294967296L AS DECIMAL(10, 0)) + CAST(__d{i} AS DECIMAL(10, 0)) AS DECIMAL(38, 0))"
        # whole digits, and a half for all that is below them: it decides a tie and nothing else
        below = " | ".join(f"__d{i}" for i in range(upto, DIGITS))
        return f"CAST(CAST({found} AS DECIMAL(38, 1)) + CASE WHEN ({below}) != 0 THEN 0.5BD ELSE 0.0BD END AS DOUBLE)"

    # two whole doubles, of which the upper has up to 53 bits and the lower those below: their sum rounds once
    below_one = (f"(CAST(__whole * {2**53}L + __d2 * {2**21}L + shiftright(__d3, 11) AS DOUBLE)"
                 f" + CAST((__d3 & {2**11 - 1}L) * {2**32}L + __d4 AS DOUBLE) * {_power(-43)}) * {_power(-53)}")
    usual = (f"(CAST(__whole * {2**32}L + __d2 AS DOUBLE)"
             f" + CAST(__d3 * 2L + CASE WHEN __d4 != 0 THEN 1L ELSE 0L END AS DOUBLE) * {_power(-33)}) * {_power(-32)}")
    exact = (f"CASE WHEN __whole IN (0L, -1L) THEN {below_one} WHEN abs(__whole) < {2**20}L THEN {usual}"
             f" WHEN abs(__d0) < {2**24}L THEN {number(4)} * {_power(-64)} ELSE {number(2)} END")
    return rows.select(*kept, F.expr(f"coalesce(sum_beyond, coalesce(sum_rest, 0D) * {_power(-96)}) + {exact}").alias(name))

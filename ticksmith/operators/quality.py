"""Bad-record isolation: split tagged rows into (good, quarantine).

Parsers in :mod:`ticksmith.functions` tag each row with ``_reason`` (NULL =
usable).  Nothing throws per row, so one broken symbol never stops the others.
Both halves come from the same lineage; persist the tagged frame (or write
the quarantine inside ``foreachBatch`` after ``persist``) when both are
consumed, so the parse runs once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.functions.ticks_json import is_blank, is_number

TICK_COLUMNS = ("from", "to", "timestamp", "rate")


def split(
    tagged: DataFrame,
    reason_col: str = "_reason",
    good_columns: tuple[str, ...] | None = TICK_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """(good rows projected to ``good_columns``, rows with a reason)."""
    good = tagged.where(F.col(reason_col).isNull())
    if good_columns is not None:
        good = good.select(*good_columns)
    bad = tagged.where(F.col(reason_col).isNotNull()).withColumnRenamed(reason_col, "reason")
    return good, bad


def reason_counts(bad: DataFrame) -> DataFrame:
    """Quarantine size per reason (a partial + final aggregate, tiny output)."""
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def require_event_time(ticks: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Rows without an event time never form a window (Catalyst infers the same
    ``isnotnull`` for ``window()``; stated here so it is pushed to the scan)."""
    return ticks.where(F.col(time_col).isNotNull())


def tag_ticks_table(ticks: DataFrame) -> DataFrame:
    """Tag an already-typed tick relation (``from, to, timestamp, rate``):
    ``_reason`` names a missing field, ``_raw`` keeps the row as JSON."""
    reason = (
        F.when(is_blank(F.col("from")) | is_blank(F.col("to")), F.lit("missing from/to"))
        .when(F.col("timestamp").isNull(), F.lit("missing timestamp"))
        .when(~is_number(F.col("rate")), F.lit("missing rate"))
    )
    return ticks.select(
        *TICK_COLUMNS,
        F.to_json(F.struct(*TICK_COLUMNS)).alias("_raw"),
        reason.alias("_reason"),
    )


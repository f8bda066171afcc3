"""Read side: the dashboard's series queries as parameterised DataFrames.

Each panel is ``SELECT <aliases> FROM <windowed table> WHERE window_start
BETWEEN :start AND :end AND from_currency = :coin ORDER BY ...``.  Parameters
are function arguments (no SQL text substitution).  On a stored table the two
predicates prune ``window_date`` partitions and push to row groups; on a
table computed on the fly from ticks, :func:`windowed_for_range` bounds the
tick scan to the event times that can fall into the requested windows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.config import DEFAULT_LOOKBACK
from ticksmith.functions.timecols import interval, relative_range
from ticksmith.operators.filters import panel_filter, symbol_is
from ticksmith.operators.tumbling import tumbling


def _ordered(df: DataFrame) -> DataFrame:
    # The panel SQL orders by currency only; time is the tie-break a plot needs.
    return df.orderBy("currency", "time")


def price_series(table_1m: DataFrame, coin: str, start, end) -> DataFrame:
    """``currency, rate, time`` of one coin (1-minute means)."""
    return _ordered(
        table_1m.where(panel_filter(coin, start, end)).select(
            F.col("from_currency").alias("currency"),
            F.col("rate").alias("rate"),
            F.col("window_start").alias("time"),
        )
    )


def high_low_series(table: DataFrame, coin: str, start, end) -> DataFrame:
    """``currency, high, low, time`` (candlestick panels; unquoted aliases fold to
    lower case in the original's database)."""
    return _ordered(
        table.where(panel_filter(coin, start, end)).select(
            F.col("from_currency").alias("currency"),
            F.col("high_rate").alias("high"),
            F.col("low_rate").alias("low"),
            F.col("window_start").alias("time"),
        )
    )


def min_avg_max_series(table: DataFrame, coin: str, start, end) -> DataFrame:
    """``currency, minimum, average, maximum, time``."""
    return _ordered(
        table.where(panel_filter(coin, start, end)).select(
            F.col("from_currency").alias("currency"),
            F.col("low_rate").alias("minimum"),
            F.col("avg_rate").alias("average"),
            F.col("high_rate").alias("maximum"),
            F.col("window_start").alias("time"),
        )
    )


def coin_list(table_1m: DataFrame) -> DataFrame:
    """Sorted distinct coins (the dashboard variable)."""
    return table_1m.select("from_currency").distinct().orderBy("from_currency")


def last(lookback: str = DEFAULT_LOOKBACK, now: dt.datetime | None = None) -> tuple[dt.datetime, dt.datetime]:
    """The relative range ``now - lookback .. now``; pass ``now`` for repeatable runs."""
    if now is None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return relative_range(now, lookback)


def windowed_for_range(ticks_reader, width: str, aggs: dict, start, end, coin: str | None = None) -> DataFrame:
    """The windowed table for ``start <= window_start <= end`` computed from ticks.

    ``ticks_reader(since, until)`` returns ticks with event time in
    ``[since, until)``; windows starting in the range need exactly the ticks
    with ``start_floor <= ts < end + width``, so that is all that is scanned.
    """
    since = _floor(start, width)
    until = _to_dt(end) + interval(width)
    df = tumbling(ticks_reader(since, until), width, aggs)
    if coin is not None:
        df = df.where(symbol_is(coin))
    return df


def _to_dt(v) -> dt.datetime:
    return v if isinstance(v, dt.datetime) else dt.datetime.fromisoformat(str(v))


def _floor(v, width: str) -> dt.datetime:
    t = _to_dt(v)
    secs = int(interval(width).total_seconds())
    epoch = dt.datetime(1970, 1, 1)
    off = int((t - epoch).total_seconds()) // secs * secs
    return epoch + dt.timedelta(seconds=off)

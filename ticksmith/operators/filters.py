"""Predicates of the read side and of ingestion.

All are plain Column predicates on stored columns, so on a Parquet table they
reach the scan as ``PushedFilters`` (and partition filters when the table is
partitioned by ``window_date``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.functions.timecols import as_ntz


def symbol_is(coin: str, col: str = "from_currency") -> Column:
    """Equality on the coin parameter: ``from_currency = '<coin>'``."""
    return F.col(col) == F.lit(coin)


def time_between(start, end, col: str = "window_start") -> Column:
    """Closed range ``start <= col <= end`` (the dashboard's time filter)."""
    return F.col(col).between(as_ntz(start), as_ntz(end))


def panel_filter(coin: str, start, end, coin_col: str = "from_currency", time_col: str = "window_start") -> Column:
    """Conjunction of the coin and time-range predicates."""
    return symbol_is(coin, coin_col) & time_between(start, end, time_col)


def symbols_in(df: DataFrame, symbols: Iterable[str], col: str = "from") -> DataFrame:
    """Keep rows whose symbol is one of ``symbols``.

    A literal list becomes an ``In`` predicate pushed to the scan; for a list
    held in a table use :func:`symbols_in_table` instead.
    """
    return df.where(F.col(col).isin(list(symbols)))


def symbols_in_table(df: DataFrame, symbols: DataFrame, col: str = "from", symbol_col: str = "symbol") -> DataFrame:
    """Membership against a symbol table (left semi join).

    Nothing is counted beforehand: Spark broadcasts the symbols if they turn out to be smaller than
    ``spark.sql.autoBroadcastJoinThreshold``, else both sides shuffle on the symbol and a
    hot symbol's rows are split (AQE).
    """
    return df.join(symbols.select(F.col(symbol_col).alias(col)).distinct(), on=col, how="left_semi")

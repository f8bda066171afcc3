"""The request grid: every (symbol, target currency) pair to poll.

Targets are a short literal list, so they are attached with ``explode`` of an
array literal -- a per-row generator, no join and no shuffle.  Symbols may be
a literal list or a DataFrame column (e.g. the distinct symbols of a table).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.config import SYMBOLS, TARGET_CURRENCY
from ticksmith.functions.keys import message_key, request_url

# Neutral default; the real quote-service URL is deployment configuration.
DEFAULT_URL_TEMPLATE = "https://quotes.invalid/v2/quotes/latest?symbol=%s&convert=%s"


def symbols_frame(spark: SparkSession, symbols: Iterable[str] = SYMBOLS) -> DataFrame:
    return spark.createDataFrame([(s,) for s in symbols], "symbol string")


def request_grid(
    symbols: DataFrame,
    targets: Iterable[str] = (TARGET_CURRENCY,),
    url_template: str = DEFAULT_URL_TEMPLATE,
    symbol_col: str = "symbol",
) -> DataFrame:
    """``symbol, currency, key, url`` for each symbol row and each target."""
    targets = list(targets)
    return symbols.select(
        F.col(symbol_col).alias("symbol"),
        F.explode(F.array(*[F.lit(t) for t in targets])).alias("currency"),
    ).select(
        "symbol",
        "currency",
        message_key("symbol", "currency").alias("key"),
        request_url(url_template, "symbol", "currency").alias("url"),
    )

"""Roll coarser tumbling windows up from stored partial aggregates.

A coarse mean must never be a mean of finer means (SURVEY: ticks are not
spread evenly over minutes).  It can be computed exactly from a stored count and
the stored parts of an exact sum; ``max``/``min`` roll up directly.  Partials at the finest width are one row per (window, key), far
fewer than ticks, so every coarser width costs a scan of the partials instead
of a scan of the ticks.

A rolled-up mean equals the mean over the ticks bit for bit (see
:mod:`ticksmith.operators.exactsum`).
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.config import TICK_KEYS
from ticksmith.functions.timecols import interval_seconds
from ticksmith.operators import exactsum
from ticksmith.operators.tumbling import tumbling

OUT_KEYS = tuple(TICK_KEYS.values())


def partials(ticks: DataFrame, width: str, **kw) -> DataFrame:
    """``window_start, window_end, from_currency, to_currency, n``, the parts of the sum, ``high, low``."""
    return tumbling(ticks, width, {"n": "count", "high": "max", "low": "min"}, keep_sums=True, **kw)


def finest_width(widths) -> str:
    """The largest width that divides all ``widths`` (their gcd), e.g. 1 minute."""
    g = 0
    for w in widths:
        g = math.gcd(g, interval_seconds(w))
    return f"{g} seconds"


def rollup(parts: DataFrame, width: str, aggs: Mapping[str, str], keys=OUT_KEYS) -> DataFrame:
    """Windows of ``width`` from partials of a width that divides it.

    ``aggs`` uses the same layout as :func:`tumbling` (``avg``, ``max``,
    ``min``, ``sum``, ``count`` over the tick value).
    """
    merged = (
        parts.groupBy(F.window(F.col("window_start"), width).alias("w"), *keys)
        .agg(F.sum("n").alias("n"), F.max("high").alias("high"), F.min("low").alias("low"),
             *[c.alias(name) for name, c in exactsum.merged().items()])
        .where(F.col("n") > 0)
    )
    merged = exactsum.with_total(merged, "total")
    exprs = {
        "avg": F.col("total") / F.col("n"),
        "mean": F.col("total") / F.col("n"),
        "max": F.col("high"),
        "min": F.col("low"),
        "sum": F.col("total"),
        "count": F.col("n"),
    }
    return merged.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *keys,
        *[exprs[fn].alias(name) for name, fn in aggs.items()],
    )

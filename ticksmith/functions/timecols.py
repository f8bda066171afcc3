"""Time helpers: tumbling buckets and relative ranges with an explicit "now"."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": 86400,
    "week": 7 * 86400,
}


def interval_seconds(text: str) -> int:
    """Seconds in a simple interval string such as ``"5 minutes"``."""
    total = 0
    for n, unit in re.findall(r"(\d+)\s*([a-z]+?)s?\b", text.lower()):
        if unit not in _UNITS:
            raise ValueError(f"unsupported interval unit in {text!r}")
        total += int(n) * _UNITS[unit]
    if not total:
        raise ValueError(f"not an interval: {text!r}")
    return total


def interval(text: str) -> dt.timedelta:
    return dt.timedelta(seconds=interval_seconds(text))


def bucket_start(ts: str | Column, width: str) -> Column:
    """Start of the half-open tumbling window ``[start, start + width)`` of ``ts``,
    aligned to the epoch."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.window(c, width).start


def relative_range(now: dt.datetime, lookback: str) -> tuple[dt.datetime, dt.datetime]:
    """``(now - lookback, now)`` -- the dashboard's "last 3 hours"."""
    return now - interval(lookback), now


def relative_range_col(lookback: str) -> tuple[Column, Column]:
    """The same range against the session clock (non-deterministic; live use)."""
    now = F.localtimestamp()
    return now - F.expr(f"INTERVAL {lookback}"), now


def as_ntz(value) -> Column:
    """A wall-clock literal comparable with TIMESTAMP_NTZ columns."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")

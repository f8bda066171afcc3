"""Sink schema contract and key uniqueness.

The windowed tables declare column names, types and NOT NULL, and limit the
currency codes to 10 characters.  :func:`conform` casts a frame to the sink
schema and splits off rows that would violate it (instead of failing the
whole batch at the database), :func:`duplicate_keys` finds key collisions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.config import CURRENCY_MAX_LEN
from ticksmith.schema import SINK_KEY

LENGTH_LIMITED = ("from_currency", "to_currency")


def conform(df: DataFrame, schema: T.StructType, max_len: int = CURRENCY_MAX_LEN) -> tuple[DataFrame, DataFrame]:
    """(rows cast to ``schema`` that satisfy it, violating rows with ``reason``).

    Columns are matched by name; missing columns are an error (raised at plan
    time, not per row).  Casts use ``try_cast`` so a bad value becomes a
    violation instead of an exception.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"sink columns missing: {missing}")
    cast = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    reason = F.lit(None).cast("string")
    checks = []
    for f in schema.fields:
        if not f.nullable:
            checks.append((F.col(f.name).isNull(), f"{f.name} is null"))
        if f.name in LENGTH_LIMITED:
            checks.append((F.length(f.name) > max_len, f"{f.name} longer than {max_len}"))
    for cond, text in reversed(checks):
        reason = F.when(cond, F.lit(text)).otherwise(reason)
    tagged = cast.withColumn("_reason", reason)
    ok = tagged.where(F.col("_reason").isNull()).drop("_reason")
    bad = tagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return ok, bad


def duplicate_keys(df: DataFrame, key: Sequence[str] = SINK_KEY) -> DataFrame:
    """Keys that occur more than once, with their count (partial + final aggregate)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, key: Sequence[str] = SINK_KEY) -> None:
    """Raise when ``key`` is not unique in ``df`` (runs one aggregate job)."""
    dup = duplicate_keys(df, key).limit(5).collect()
    if dup:
        raise ValueError(f"duplicate sink keys {list(key)}: {[tuple(r) for r in dup]}")

"""Tick relations from tables: the driver's ``events`` table read as ticks.

Mapping: ``event_type -> from``, a literal target currency ``-> to``,
``ts -> timestamp`` (NTZ wall clock read as a UTC instant), ``value -> rate``.

Time bounds are applied to the raw ``ts`` column *before* the cast so that
they reach the Parquet scan as ``PushedFilters`` (row-group skipping on the
ts statistics); a predicate on the casted column would not be pushed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.config import TARGET_CURRENCY
from ticksmith.session import is_folder, pin_utc

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _ntz(value) -> F.Column:
    if isinstance(value, F.Column):
        return value
    if isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def events_as_ticks(
    events: DataFrame,
    to: str = TARGET_CURRENCY,
    since=None,
    until=None,
    *,
    symbol_col: str = "event_type",
    time_col: str = "ts",
    value_col: str = "value",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``events`` rows as the tick relation ``from, to, timestamp, rate``.

    ``since`` (inclusive) / ``until`` (exclusive) bound the event time.
    ``keep`` carries extra source columns along (e.g. ``event_id``).
    """
    pin_utc(events.sparkSession)
    df = events
    if since is not None:
        df = df.where(F.col(time_col) >= _ntz(since))
    if until is not None:
        df = df.where(F.col(time_col) < _ntz(until))
    return df.select(
        F.col(symbol_col).alias("from"),
        F.lit(to).alias("to"),
        F.col(time_col).cast("timestamp").alias("timestamp"),
        F.col(value_col).cast("double").alias("rate"),
        *[F.col(c) for c in keep],
    )


def read_ticks(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Batch ticks from ``<sf_dir>/events.parquet``."""
    return events_as_ticks(read_table(spark, sf_dir, "events"), **kw)


def stream_table(
    spark: SparkSession,
    directory: str,
    name: str,
    schema=None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming scan over the Parquet files of one table in ``directory``.

    A table that is a folder of part files is read as it is, and files that land in it
    become new micro-batches.  The file source needs a directory, so a table in one file is
    selected in its folder with ``pathGlobFilter``.
    """
    path = table_path(directory, name)
    if schema is None:
        schema = spark.read.parquet(path).schema
    folder = is_folder(spark, path)  # raises if there is no such table
    r = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet" if folder else f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path if folder else directory.rstrip("/"))


def stream_ticks(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Streaming ticks from the ``events`` files of ``sf_dir``."""
    pin_utc(spark)
    return events_as_ticks(stream_table(spark, sf_dir, "events"), **kw)

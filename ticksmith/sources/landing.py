"""Tick messages landed as files (one JSON message per line).

Stands in for the topic offline: ``value`` has the same content as the
message value, so everything downstream of the source is the same code.
With ``max_files_per_trigger=1`` each file is one micro-batch, which makes
batch boundaries -- and so the late-data outcome -- repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_messages(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """``value`` (string) per landed message line."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("text")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)

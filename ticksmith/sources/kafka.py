"""Kafka stream scan of tick messages.

Any streaming DataFrame with a ``value`` column (binary or string) is accepted
by the parsers, so file or memory sources stand in for Kafka offline.  The
Kafka connector jar must be on the classpath for ``format("kafka")``.

Scale notes: one Spark task reads one topic partition per micro-batch;
``minPartitions`` splits large partitions across more tasks, and
``maxOffsetsPerTrigger`` bounds a batch so that a backlog after downtime is
worked off in steps instead of one huge batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Source options.  ``startingOffsets`` only applies when the query has no
    checkpoint yet; afterwards the checkpointed offsets win."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update({k.replace("__", "."): v for k, v in extra.items()})
    return opts


def kafka_reader(spark: SparkSession, options: dict[str, str]) -> DataStreamReader:
    return spark.readStream.format("kafka").options(**options)


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """``key, value`` (strings) of the topic."""
    raw = kafka_reader(spark, options).load()
    return raw.selectExpr("CAST(key AS STRING) AS key", "value")

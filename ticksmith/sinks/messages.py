"""Keyed tick messages: the ``key, value`` frame a topic sink expects.

Key ``<symbol>_<target>``, value the flat JSON tick.  Publishing uses the
Kafka sink with ``acks=all`` (the connector jar must be on the classpath).
Records with the same key go to the same topic partition, so per-symbol
order is kept while symbols spread over partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.functions.keys import message_key
from ticksmith.functions.ticks_json import tick_json


def message_frame(ticks: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """``key, value`` strings for each tick (``ts_col`` may be TIMESTAMP or text)."""
    return ticks.select(
        message_key("from", "to").alias("key"),
        tick_json("from", "to", F.col(ts_col), "rate").alias("value"),
    )


def kafka_sink_options(bootstrap_servers: str, topic: str, **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, "kafka.acks": "all"}
    opts.update({k.replace("__", "."): v for k, v in extra.items()})
    return opts


def write_messages(frame: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """Publish a batch frame to Kafka, or to files of another format (``path`` among the options)."""
    frame.write.format(fmt).options(**options).save()


def stream_messages(frame: DataFrame, options: dict[str, str], checkpoint: str, fmt: str = "kafka", trigger: dict | None = None):
    """Publish a streaming frame to Kafka, or through Spark's file sink (whole batches, each once); returns the running query."""
    w = frame.writeStream.outputMode("append").format(fmt).options(**options).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()

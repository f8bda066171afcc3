"""ticksmith: tick analytics on Spark.

Timestamped, keyed measurements (prices) come in as a table or a stream;
ticksmith parses and validates them, computes tumbling event-time aggregates
with the same functions in batch and in Structured Streaming, writes finished
windows to keyed sinks idempotently and serves parameterised series queries.

Everything is expressed with DataFrames / Spark SQL functions so Catalyst
plans it (pushdown, pruning, partial aggregation, codegen).
"""

from ticksmith.config import DEFAULT_JOBS, HLA, PRICE, WindowSpec
from ticksmith.operators.tumbling import tumbling
from ticksmith.session import build_session, drop_staged, pin_utc, shared_path, staged
from ticksmith.sinks.keyed import KeyedTable
from ticksmith.sources.events import read_ticks, stream_ticks
from ticksmith.streaming.jobs import start_message_jobs, start_response_jobs, start_tagged_jobs

__all__ = [
    "HLA",
    "PRICE",
    "WindowSpec",
    "DEFAULT_JOBS",
    "tumbling",
    "build_session",
    "pin_utc",
    "shared_path",
    "staged",
    "drop_staged",
    "KeyedTable",
    "read_ticks",
    "stream_ticks",
    "start_message_jobs",
    "start_response_jobs",
    "start_tagged_jobs",
]

__version__ = "0.1.0"

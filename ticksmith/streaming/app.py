"""The streaming application: ticks in, three windowed tables out.

    python -m ticksmith.streaming.app --source files --path /landing/ticks \\
        --tables /shared/tables [--checkpoints /shared/ckpt] [--trigger 30s]
    python -m ticksmith.streaming.app --source kafka --bootstrap broker:9092 \\
        --topic prices --tables /shared/tables
    python -m ticksmith.streaming.app --source responses --path /landing/responses \\
        --tables /shared/tables
    python -m ticksmith.streaming.app --source table --path /data/sf --table-name events \\
        --tables /shared/tables

Starts one query per window job (1, 5, 10 minutes; watermark = width) plus a
quarantine query, waits until any query ends, and stops all of them on exit
or on SIGTERM, naming the query that failed.  Checkpoints default to
``<spark.checkpoint.dir>/ticksmith/app``; with a checkpoint, a restart resumes
from the committed offsets and keeps open windows.
"""

from __future__ import annotations

import argparse
import json
import signal
import sys

from ticksmith.config import DEFAULT_JOBS
from ticksmith.session import build_session, checkpoint_root


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="ticksmith.streaming.app")
    p.add_argument("--source", choices=("files", "responses", "kafka", "table"), required=True)
    p.add_argument("--path", help="landing folder of tick message files or of raw response files")
    p.add_argument("--table-name", default="events", help="table source: <path>/<name>.parquet files")
    p.add_argument("--symbol-col", default="event_type")
    p.add_argument("--time-col", default="ts")
    p.add_argument("--value-col", default="value")
    p.add_argument("--target", default="EUR", help="table source: target currency of every tick")
    p.add_argument("--bootstrap", help="Kafka bootstrap servers")
    p.add_argument("--topic", default="prices")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int, help="Kafka: bound each micro-batch")
    p.add_argument("--max-files-per-trigger", type=int, help="file sources: bound each micro-batch")
    p.add_argument("--tables", required=True, help="root folder of the windowed tables")
    p.add_argument("--checkpoints", help="checkpoint root (default: under spark.checkpoint.dir)")
    p.add_argument("--trigger", help="processing-time trigger such as '30 seconds'; default back to back")
    p.add_argument("--available-now", action="store_true", help="work off available input, then stop")
    p.add_argument("--dedup", action="store_true", help="drop repeated ticks within the watermark")
    p.add_argument("--json-lines", action="store_true", help="response files: a document on each line, without a request in the file name")
    p.add_argument("--parse-once", action="store_true",
                   help="one query reads and parses the source, the window jobs read what it commits")
    p.add_argument("--max-seconds", type=float, help="stop after so many seconds, when what has come is worked off")
    p.add_argument("--drain-seconds", type=float, default=30.0, help="how long jobs may work off what has come before they are stopped")
    p.add_argument("--restarts", type=int, help="start a failed job again from its checkpoint, so often at most")
    p.add_argument("--state-partitions", type=int, help="state store partitions (fixed at first start)")
    return p.parse_args(argv)


def messages(spark, args):
    if args.source == "files":
        from ticksmith.sources.landing import read_messages

        return read_messages(spark, args.path, max_files_per_trigger=args.max_files_per_trigger)
    from ticksmith.sources.kafka import kafka_options, kafka_stream

    opts = kafka_options(
        args.bootstrap, args.topic, args.starting_offsets, max_offsets_per_trigger=args.max_offsets_per_trigger
    )
    return kafka_stream(spark, opts)


def main(argv=None) -> int:
    from ticksmith.streaming.jobs import start_message_jobs, start_response_jobs

    args = parse_args(argv)
    spark = build_session(app="ticksmith-stream", shuffle_partitions=args.state_partitions)
    ckpt = args.checkpoints or f"{checkpoint_root(spark)}/ticksmith/app"
    trigger = {"availableNow": True} if args.available_now else (
        {"processingTime": args.trigger} if args.trigger else None
    )
    if args.source == "table":
        from ticksmith.operators.quality import tag_ticks_table
        from ticksmith.sources.events import events_as_ticks, stream_table
        from ticksmith.streaming.jobs import start_tagged_jobs

        raw = stream_table(spark, args.path, args.table_name, max_files_per_trigger=args.max_files_per_trigger)
        ticks = events_as_ticks(raw, args.target, symbol_col=args.symbol_col, time_col=args.time_col,
                                value_col=args.value_col)
        group = start_tagged_jobs(tag_ticks_table(ticks), DEFAULT_JOBS, args.tables, ckpt,
                                  trigger=trigger, dedup=args.dedup, parse_once=args.parse_once)
    elif args.source == "responses":
        from ticksmith.sources.responses import read_landed

        group = start_response_jobs(
            read_landed(spark, args.path, streaming=True, one_document_per_file=not args.json_lines,
                        max_files_per_trigger=args.max_files_per_trigger),
            DEFAULT_JOBS, args.tables, ckpt,
            trigger=trigger, dedup=args.dedup, parse_once=args.parse_once,
        )
    else:
        group = start_message_jobs(
            messages(spark, args), DEFAULT_JOBS, args.tables, ckpt, trigger=trigger, dedup=args.dedup, parse_once=args.parse_once
        )

    def stop(*_):
        group.stop_all()

    try:
        signal.signal(signal.SIGTERM, stop)
    except ValueError:  # not the main thread: the caller owns signal handling
        pass
    try:
        if args.max_seconds is not None or args.restarts is not None:
            reports = group.supervise(args.max_seconds, args.restarts or 0, args.drain_seconds)
            print(json.dumps({"jobs": {name: vars(r) for name, r in reports.items()}, "dropped_late_rows": group.dropped_late_rows()}))
            return int(any(r.state in ("failed", "late") for r in reports.values()))
        if args.available_now:
            group.await_all()
            print(json.dumps({"dropped_late_rows": group.dropped_late_rows()}))
        else:
            group.await_any()
    except KeyboardInterrupt:
        pass
    finally:
        group.stop_all()
    return 0


if __name__ == "__main__":
    sys.exit(main())

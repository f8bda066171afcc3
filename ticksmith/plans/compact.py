"""Merge the small batch folders of the streamed tables, while streams write and readers read.

    python -m ticksmith.plans.compact --tables /shared/tables --first 2024-01-01 --last 2024-01-31 [--vacuum]

``--vacuum`` also removes what earlier compactions have replaced: for a time when no reader is
left that began before the last one.
"""

from __future__ import annotations

import argparse
import json
import sys

from ticksmith.config import DEFAULT_JOBS


def main(argv=None) -> int:
    from ticksmith.session import build_session
    from ticksmith.sinks.keyed import KeyedTable

    p = argparse.ArgumentParser(prog="ticksmith.plans.compact")
    p.add_argument("--tables", required=True, help="root folder of the windowed tables")
    p.add_argument("--first", required=True, help="first date")
    p.add_argument("--last", required=True, help="last date")
    p.add_argument("--rows-per-file", type=int, default=1_000_000)
    p.add_argument("--vacuum", action="store_true")
    args = p.parse_args(argv)
    spark = build_session(app="ticksmith-compact")
    for spec in DEFAULT_JOBS:
        sink = KeyedTable(f"{args.tables.rstrip('/')}/{spec.sink_table}", by_batch=True, rows_per_file=args.rows_per_file)
        removed = sink.vacuum(spark) if args.vacuum else 0
        days = sink.compact(spark, args.first, args.last)
        print(json.dumps({"table": spec.sink_table, "compacted": [str(d) for d in days], "removed": removed}))
    return 0


if __name__ == "__main__":
    sys.exit(main())

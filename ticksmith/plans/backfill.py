"""Batch backfill of the windowed tables from a tick table, in one tick scan.

The streaming jobs keep the tables current; after lost windows (a stop
without checkpoint, a late-data policy change) or for a new width, the tables
are rebuilt in batch:

1. one scan of the ticks -> partials ``(n, total, high, low)`` at the
   greatest common width (1 minute for 1/5/10 minutes);
2. the partials are written to the shared folder -- this cuts the lineage, so
   a lost executor re-reads the partials instead of re-scanning the ticks;
3. every width is rolled up from the partials and written with
   :meth:`KeyedTable.backfill` (dynamic overwrite of the dates present).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ticksmith.config import WindowSpec
from ticksmith.operators.rollup import finest_width, partials, rollup
from ticksmith.session import shared_path
from ticksmith.sinks.keyed import KeyedTable


def stage_partials(ticks: DataFrame, width: str, path: str | None = None) -> DataFrame:
    """Write the partials under the shared folder and read them back."""
    spark = ticks.sparkSession
    path = path or shared_path(spark, "partials")
    parts = partials(ticks, width)
    parts.hint("rebalance").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def rolled_up(ticks: DataFrame, specs: Iterable[WindowSpec], partials_path: str | None = None) -> dict[str, DataFrame]:
    """Each spec's windowed rows, all derived from one tick scan."""
    specs = list(specs)
    parts = stage_partials(ticks, finest_width(s.width for s in specs), partials_path)
    return {s.name: rollup(parts, s.width, s.aggs) for s in specs}


def backfill_tables(ticks: DataFrame, specs: Iterable[WindowSpec], table_root: str) -> dict[str, KeyedTable]:
    """Rebuild ``<table_root>/<sink_table>`` for every spec.

    Every date present in the output is replaced whole, so ``ticks`` must hold
    whole days (the CLI widens ``--since/--until`` to day boundaries).
    """
    specs = list(specs)
    frames = rolled_up(ticks, specs)
    out = {}
    for s in specs:
        sink = KeyedTable(f"{table_root.rstrip('/')}/{s.sink_table}", by_batch=True)  # the layout that streams write
        sink.backfill(frames[s.name])
        out[s.name] = sink
    return out


def main(argv=None) -> int:
    """``python -m ticksmith.plans.backfill --path /data/sf --tables /shared/tables``"""
    import argparse

    from ticksmith.config import DEFAULT_JOBS
    from ticksmith.session import build_session
    from ticksmith.sources.events import events_as_ticks, read_table

    p = argparse.ArgumentParser(prog="ticksmith.plans.backfill")
    p.add_argument("--path", required=True, help="folder holding <table-name>.parquet")
    p.add_argument("--table-name", default="events")
    p.add_argument("--symbol-col", default="event_type")
    p.add_argument("--time-col", default="ts")
    p.add_argument("--value-col", default="value")
    p.add_argument("--target", default="EUR")
    p.add_argument("--since", help="first event time to include (inclusive)")
    p.add_argument("--until", help="event time bound (exclusive)")
    p.add_argument("--tables", required=True, help="root folder of the windowed tables")
    args = p.parse_args(argv)
    # Dates are replaced whole, so the range is widened to whole days: a date
    # cut in half would be overwritten with half of its windows.
    since = _day_floor(args.since) if args.since else None
    until = _day_ceil(args.until) if args.until else None
    spark = build_session(app="ticksmith-backfill")
    ticks = events_as_ticks(
        read_table(spark, args.path, args.table_name), args.target, since, until,
        symbol_col=args.symbol_col, time_col=args.time_col, value_col=args.value_col,
    )
    backfill_tables(ticks, DEFAULT_JOBS, args.tables)
    return 0


def _day_floor(text: str):
    import datetime as dt

    t = dt.datetime.fromisoformat(text)
    return dt.datetime(t.year, t.month, t.day)


def _day_ceil(text: str):
    import datetime as dt

    t = dt.datetime.fromisoformat(text)
    floor = dt.datetime(t.year, t.month, t.day)
    return floor if t == floor else floor + dt.timedelta(days=1)


if __name__ == "__main__":
    import sys

    sys.exit(main())

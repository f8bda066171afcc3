"""Named queries over the driver tables and their DuckDB oracle SQL.

Every query reads the given tables (or data Spark derives from them) in full;
its work grows with them.  Oracle SQL runs in DuckDB over the same Parquet
files, pre-registered as views named like the tables.  Column names are equal
on both sides.

``events`` rows are read as ticks (event_type -> symbol, 'EUR' -> target,
ts -> event time, value -> rate).  Bad records for the quarantine paths are
derived from the data itself, never by dropping rows: requests for the
'error' symbol are answered with an error status, and messages whose payload
field ``k`` is below 10 carry an unparseable event time.  Every row is still
processed; the bad ones end in the quarantine with a reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticksmith.config import HLA, PRICE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --------------------------------------------------------------------------
# Oracle SQL building blocks (DuckDB dialect)
# --------------------------------------------------------------------------

# The mean is the rounded exact sum by the count: values times 2**80 are whole numbers, and text to double rounds once.
_DUCK_SUM = "CAST(CAST(sum(CAST(value * pow(2, 80) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2, 80)"
_DUCK_AGG = {"avg": f"{_DUCK_SUM} / count(value)", "max": "max(value)", "min": "min(value)", "sum": _DUCK_SUM, "count": "count(value)"}


def duck_interval(width: str) -> str:
    return f"INTERVAL '{width}'"


def duck_tumbling_sql(width: str, aggs: dict, where: str = "TRUE", source: str = "events") -> str:
    iv = duck_interval(width)
    agg_sql = ",\n       ".join(f"{_DUCK_AGG[fn]} AS {name}" for name, fn in aggs.items())
    return f"""
SELECT time_bucket({iv}, ts) AS window_start,
       time_bucket({iv}, ts) + {iv} AS window_end,
       event_type AS from_currency,
       'EUR' AS to_currency,
       {agg_sql}
FROM {source}
WHERE ts IS NOT NULL AND value IS NOT NULL AND ({where})
GROUP BY 1, 2, 3, 4
""".strip()


# Widths registered as batch tumbling aggregates: key suffix -> (width, layout).
BATCH_WIDTHS = {
    "avg_1m": ("1 minute", PRICE),
    "hla_5m": ("5 minutes", HLA),
    "hla_10m": ("10 minutes", HLA),
    "hla_1h": ("1 hour", HLA),
    "hla_1d": ("1 day", HLA),
}


def _tumbling_query(width: str, aggs: dict):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ticksmith.operators.tumbling import tumbling
        from ticksmith.sources.events import read_ticks

        return tumbling(read_ticks(spark, sf_dir), width, aggs)

    return q


for _suffix, (_width, _aggs) in BATCH_WIDTHS.items():
    register(f"tumbling_{_suffix}", duck_tumbling_sql(_width, _aggs))(
        _tumbling_query(_width, _aggs)
    )


# --------------------------------------------------------------------------
# Shared parameters of the registered queries
# --------------------------------------------------------------------------

# Serving parameters: the coin variable and a fixed "now" so runs repeat.
PANEL_COIN = "purchase"
PANEL_NOW = "2024-01-22 00:00:00"
PANEL_LOOKBACK = "14 days"
PANEL_START = "2024-01-08 00:00:00"  # PANEL_NOW - PANEL_LOOKBACK
# Watched symbols for the membership filter.
WATCHED = ("click", "purchase", "view")
# Requests the quote service answers with an error status: the 'error' events.
FAILED_SYMBOL = "error"
# Ticks whose event-time text is corrupted: payload field k below this value.
BAD_TIME_BELOW_K = 10
BAD_TIME_TEXT = "not a time"


def _ticks(spark, sf_dir, **kw):
    from ticksmith.sources.events import read_ticks

    return read_ticks(spark, sf_dir, **kw)


def _ntz(col):
    return col.cast("timestamp_ntz")


# --------------------------------------------------------------------------
# Streaming: append-mode window jobs over the events files (availableNow)
# --------------------------------------------------------------------------

STREAM_WIDTHS = {
    "avg_1m": ("1 minute", PRICE),
    "hla_5m": ("5 minutes", HLA),
    "hla_10m": ("10 minutes", HLA),
}


STREAM_BATCHES = 3


def run_stream_job(spark: SparkSession, sf_dir: str, width: str, aggs: dict, tag: str, dedup: bool = False) -> str:
    """Run one window job over the ticks, landed in the order of time for STREAM_BATCHES batches; return the table path."""
    from ticksmith.config import WindowSpec
    from ticksmith.session import shared_path
    from ticksmith.sinks.keyed import KeyedTable
    from ticksmith.streaming.jobs import start_window_jobs
    from ticksmith.streaming.replay import land_in_order, ordered_stream

    run = shared_path(spark, "stream", tag)
    spec = WindowSpec(tag, width, width, dict(aggs))
    sink = KeyedTable(f"{run}/table", by_batch=True)
    ticks, files = _ticks(spark, sf_dir), max(2, spark.sparkContext.defaultParallelism)
    land_in_order(ticks, f"{run}/landed", "timestamp", STREAM_BATCHES * files)
    stream = ordered_stream(spark, f"{run}/landed", ticks.schema, files)
    group = start_window_jobs(stream, [spec], {tag: sink}, f"{run}/checkpoint", trigger={"availableNow": True}, dedup=dedup)
    _run_group(group)
    return sink.path


def _stream_query(width: str, aggs: dict, tag: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ticksmith.sources.tables import read_windowed

        return read_windowed(spark, run_stream_job(spark, sf_dir, width, aggs, tag))

    return q


for _suffix, (_width, _aggs) in STREAM_WIDTHS.items():
    _closed = (
        f"SELECT * FROM ({duck_tumbling_sql(_width, _aggs)}) w "
        f"WHERE window_end <= (SELECT max(ts) FROM events) - {duck_interval(_width)}"
    )
    register(f"stream_{_suffix}", _closed)(_stream_query(_width, _aggs, _suffix))


_CLOSED_5M = (
    f"SELECT * FROM ({duck_tumbling_sql('5 minutes', HLA)}) w "
    f"WHERE window_end <= (SELECT max(ts) FROM events) - {duck_interval('5 minutes')}"
)


def _stream_5m(spark: SparkSession, ticks: DataFrame, run: str, checkpoint: str):
    """The 5-minute job over a stream of ticks, to its end, into the table of ``run``."""
    from ticksmith.config import WindowSpec
    from ticksmith.sinks.keyed import KeyedTable
    from ticksmith.streaming.jobs import start_window_query

    sink = KeyedTable(f"{run}/rate_5min", by_batch=True)
    q = start_window_query(ticks, WindowSpec("5min", "5 minutes", "5 minutes", dict(HLA), "rate_5min"), sink,
                           f"{run}/{checkpoint}", trigger={"availableNow": True})
    q.awaitTermination()
    return sink


@register("restart_new_checkpoint_5m", _CLOSED_5M)
def restart_new_checkpoint_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier half of the ticks, then all of them with a new checkpoint into the
    same table: nothing stored is lost or repeated."""
    from pyspark.sql import functions as F

    from ticksmith.session import shared_path
    from ticksmith.sources.events import stream_ticks

    run = shared_path(spark, "stream", "restart")
    lo, hi = _ticks(spark, sf_dir).agg(F.min("timestamp").cast("double"), F.max("timestamp").cast("double")).first()
    ticks = stream_ticks(spark, sf_dir)
    if lo is not None:
        _stream_5m(spark, ticks.where(F.col("timestamp").cast("double") < (lo + hi) / 2), run, "first")
    return _stream_5m(spark, ticks, run, "second").read(spark)


@register("stream_then_backfill_5m", _CLOSED_5M)
def stream_then_backfill_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5-minute job, then a batch backfill of all days before the last into the
    same root; the table is read as one."""
    import datetime as dt

    from pyspark.sql import functions as F

    from ticksmith.config import WindowSpec
    from ticksmith.plans.backfill import backfill_tables
    from ticksmith.session import shared_path
    from ticksmith.sources.events import read_table, read_ticks, stream_ticks

    run = shared_path(spark, "stream", "backfill")
    sink = _stream_5m(spark, stream_ticks(spark, sf_dir), run, "checkpoint")
    last = read_table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    if last is not None:
        closed = last - dt.timedelta(minutes=10)  # the day of the last closed window stays with the stream
        backfill_tables(read_ticks(spark, sf_dir, until=closed.replace(hour=0, minute=0, second=0, microsecond=0)),
                        [WindowSpec("5min", "5 minutes", "5 minutes", dict(HLA), "rate_5min")], run)
    return sink.read(spark)


# Late data: the ticks land in four batches, by the quarter of the month they fall in, but for those
# held back.  Cheap views of the second quarter come with the fourth (late: dropped); sign-ups of the last
# minutes of a quarter come with the next (in time: counted).
_HELD_SYMBOL, _HELD_BELOW = "view", 20.0
_SLOW_SYMBOL, _SLOW_SECONDS = "signup", 200
_LATE_SQL = f"""
WITH bounds AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events
), quarters AS (
  SELECT ts, event_type, value, least(3, 4 * (epoch_us(ts) - lo) // (hi - lo)) AS quarter FROM events, bounds
), lasts AS (SELECT quarter, max(ts) AS last FROM quarters GROUP BY quarter
), held AS (
  SELECT ts, event_type, value, CAST(CASE
    WHEN quarter = 1 AND event_type = '{_HELD_SYMBOL}' AND value < {_HELD_BELOW} THEN 3
    WHEN quarter < 3 AND event_type = '{_SLOW_SYMBOL}' AND ts > last - INTERVAL '{_SLOW_SECONDS} seconds' THEN quarter + 1
    ELSE quarter END AS INTEGER) AS batch
  FROM quarters JOIN lasts USING (quarter)
), marks AS (
  SELECT b.batch, max(h.ts) - INTERVAL '5 minutes' AS watermark
  FROM (SELECT DISTINCT batch FROM held) b LEFT JOIN held h ON h.batch < b.batch GROUP BY b.batch
), judged AS (
  SELECT held.*, coalesce(time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= watermark, FALSE) AS late
  FROM held JOIN marks USING (batch)
)"""


def _late_drop(spark: SparkSession, sf_dir: str, after=None):
    """The 5-minute job over four landed batches, restarted from its checkpoint for each; ``after(runs so far, table)``."""
    from pyspark.sql import functions as F

    from ticksmith.config import WindowSpec
    from ticksmith.session import shared_path
    from ticksmith.sinks.keyed import KeyedTable
    from ticksmith.sources.events import read_table
    from ticksmith.streaming.jobs import start_window_jobs
    from ticksmith.streaming.replay import landed_stream, replay

    run = shared_path(spark, "stream", "late")
    micros = F.unix_micros(F.col("timestamp"))
    ticks = _ticks(spark, sf_dir)
    bounds = read_table(spark, sf_dir, "events").agg(
        F.unix_micros(F.min("ts").cast("timestamp")).alias("lo"), F.unix_micros(F.max("ts").cast("timestamp")).alias("hi")).first()
    lo, hi = bounds.lo or 0, bounds.hi or 1
    quarter = F.least(F.lit(3).cast("long"), F.expr(f"4 * (unix_micros(timestamp) - {lo}L) div {max(1, hi - lo)}L"))
    quarters = ticks.withColumn("quarter", quarter)
    lasts = {r.quarter: r.last for r in quarters.groupBy("quarter").agg(F.max(micros).alias("last")).collect()}
    slow = F.lit(False)
    for q, last in lasts.items():
        slow = slow | ((F.col("quarter") == q) & (F.lit(q) < 3) & (micros > last - _SLOW_SECONDS * 1_000_000))
    batch = (
        F.when((F.col("quarter") == 1) & (F.col("from") == _HELD_SYMBOL) & (F.col("rate") < _HELD_BELOW), 3)
        .when((F.col("from") == _SLOW_SYMBOL) & slow, F.col("quarter") + 1)
        .otherwise(F.col("quarter")))
    landed = quarters.withColumn("batch", batch).drop("quarter")
    spec = WindowSpec("5min", "5 minutes", "5 minutes", dict(HLA), "rate_5min")
    sink, runs = KeyedTable(f"{run}/rate_5min", by_batch=True), []

    def to_the_end():
        group = start_window_jobs(
            landed_stream(spark, f"{run}/landed", ticks.schema), [spec], {"5min": sink}, f"{run}/checkpoints", trigger={"availableNow": True})
        group.await_all()
        runs.append(group)
        if after is not None:
            after(len(runs), sink)
        return group

    group = replay(spark, [landed.where(F.col("batch") == k).drop("batch") for k in range(4)], f"{run}/landed", to_the_end)
    return sink, group


_LATE_5M = (
    _LATE_SQL + f" SELECT * FROM ({duck_tumbling_sql('5 minutes', HLA, where='NOT late', source='judged')}) w "
    f"WHERE window_end <= (SELECT max(ts) FROM events) - {duck_interval('5 minutes')}")


@register("late_drop_5m", _LATE_5M)
def late_drop_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of a stream with late ticks, as they count: those held back too long are not in them."""
    return _late_drop(spark, sf_dir)[0].read(spark)


@register("compacted_5m", _LATE_5M)
def compacted_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, compacted after each of the first three runs and cleaned up after the second:
    the last run's batches lie beside compacted dates, and some dates have been compacted more than once."""
    import datetime as dt

    def after(runs, sink):
        if runs < 4:
            sink.compact(spark, dt.date.min, dt.date.max)
        if runs == 2:
            sink.vacuum(spark)

    return _late_drop(spark, sf_dir, after)[0].read(spark)


@register(
    "late_drop_counts",
    _LATE_SQL + """
SELECT '5min' AS name, count(DISTINCT batch) AS data_batches, count(*) AS input_rows,
       (SELECT count(*) FROM (SELECT DISTINCT batch, event_type, time_bucket(INTERVAL '5 minutes', ts) FROM judged WHERE late)) AS dropped_rows
FROM judged""",
)
def late_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log of all four runs has: batches, ticks read, and windows (with their key) that late ticks were dropped for."""
    from ticksmith.streaming.progress import totals

    return totals(_late_drop(spark, sf_dir)[1].log.read())


def _land_text(df: DataFrame, path: str) -> str:
    """Write one text column as landed files (the source's own partitioning)."""
    df.write.mode("overwrite").text(path)
    return path


def _run_group(group) -> None:
    group.await_all()
    for name, q in group.queries.items():
        if q.exception() is not None:
            raise RuntimeError(f"stream job {name} failed: {q.exception()}")


@register("message_stream_hla_5m", _CLOSED_5M)
def message_stream_hla_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming application end to end: events as flat JSON tick messages
    landed in files -> parse + quarantine -> 5-minute job -> keyed table."""
    from ticksmith.config import WindowSpec
    from ticksmith.functions.ticks_json import tick_json
    from ticksmith.session import shared_path
    from ticksmith.sources.landing import read_messages
    from ticksmith.streaming.jobs import start_message_jobs

    run = shared_path(spark, "app", "messages")
    landing = _land_text(_ticks(spark, sf_dir).select(tick_json().alias("value")), f"{run}/landing")
    spec = WindowSpec("5min", "5 minutes", "5 minutes", dict(HLA), "rate_5min")
    group = start_message_jobs(
        read_messages(spark, landing), [spec], f"{run}/tables", f"{run}/checkpoints",
        trigger={"availableNow": True},
    )
    _run_group(group)
    return group.tables["5min"].read(spark)


_GOOD_TIME = f"TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) >= {BAD_TIME_BELOW_K}"
_FAN_OUT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS job, window_start, window_end, from_currency, to_currency, {columns} "
    f"FROM ({duck_tumbling_sql(width, aggs, where=_GOOD_TIME)}) w "
    f"WHERE window_end <= (SELECT max(ts) FROM events WHERE {_GOOD_TIME}) - {duck_interval(width)}"
    for name, width, aggs, columns in (
        ("1min", "1 minute", PRICE, "rate AS high_rate, rate AS low_rate, rate AS avg_rate"),
        ("5min", "5 minutes", HLA, "high_rate, low_rate, avg_rate"), ("10min", "10 minutes", HLA, "high_rate, low_rate, avg_rate")))


def _fan_out(spark: SparkSession, sf_dir: str):
    """The three jobs behind one parse of the tick messages, some with a bad time; the group, ended, and its folder."""
    from pyspark.sql import functions as F

    from ticksmith.config import DEFAULT_JOBS
    from ticksmith.functions.ticks_json import tick_json
    from ticksmith.session import shared_path
    from ticksmith.sources.landing import read_messages
    from ticksmith.streaming.jobs import start_message_jobs

    run = shared_path(spark, "app", "fanout")
    k = F.get_json_object("props", "$.k").try_cast("int")
    ts_text = F.when(k >= BAD_TIME_BELOW_K, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).otherwise(F.lit(BAD_TIME_TEXT))
    landing = _land_text(_ticks(spark, sf_dir, keep=("props",)).select(tick_json("from", "to", ts_text, "rate").alias("value")), f"{run}/landing")
    group = start_message_jobs(
        read_messages(spark, landing), DEFAULT_JOBS, f"{run}/tables", f"{run}/checkpoints", trigger={"availableNow": True}, parse_once=True)
    _run_group(group)
    return group, f"{run}/tables"


@register("fanout_1_5_10m", _FAN_OUT_SQL)
def fanout_1_5_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of all three jobs, which read the ticks that one query has parsed (the 1-minute table has a mean alone)."""
    from pyspark.sql import functions as F

    group, _ = _fan_out(spark, sf_dir)
    out = None
    for name, sink in group.tables.items():
        t = sink.read(spark)
        high, low, avg = ("rate",) * 3 if "rate" in t.columns else ("high_rate", "low_rate", "avg_rate")
        t = t.select(F.lit(name).alias("job"), "window_start", "window_end", "from_currency", "to_currency",
                     F.col(high).alias("high_rate"), F.col(low).alias("low_rate"), F.col(avg).alias("avg_rate"))
        out = t if out is None else out.unionByName(t)
    return out


@register("fanout_rejects", f"""
SELECT 'missing or unparseable timestamp' AS reason, event_type AS "from", count(*) AS n
FROM events WHERE NOT {_GOOD_TIME} GROUP BY ALL""")
def fanout_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that the one parse has set aside."""
    from pyspark.sql import functions as F

    from ticksmith.streaming.jobs import parsed_rejects

    _, root = _fan_out(spark, sf_dir)
    return parsed_rejects(spark, f"{root}/parsed").groupBy("reason", F.get_json_object("raw", "$.from").alias("from")).agg(
        F.count(F.lit(1)).alias("n"))


_NOT_FAILED = f"event_type <> '{FAILED_SYMBOL}'"


@register(
    "response_stream_hla_10m",
    f"SELECT * FROM ({duck_tumbling_sql('10 minutes', HLA, where=_NOT_FAILED)}) w "
    f"WHERE window_end <= (SELECT max(ts) FROM events WHERE {_NOT_FAILED}) "
    f"- {duck_interval('10 minutes')}",
)
def response_stream_hla_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw quote responses landed as JSON lines (error answers for the 'error'
    events) -> status check + quote flatten + quarantine -> 10-minute job."""
    from ticksmith.config import WindowSpec
    from ticksmith.session import shared_path
    from ticksmith.sources.responses import read_landed
    from ticksmith.streaming.jobs import start_response_jobs

    run = shared_path(spark, "app", "responses")
    landing = _land_text(_landed(spark, sf_dir).select("body"), f"{run}/landing")
    spec = WindowSpec("10min", "10 minutes", "10 minutes", dict(HLA), "rate_10min")
    group = start_response_jobs(
        read_landed(spark, landing, streaming=True, one_document_per_file=False),
        [spec], f"{run}/tables", f"{run}/checkpoints", trigger={"availableNow": True},
    )
    _run_group(group)
    return group.tables["10min"].read(spark)


@register("stream_dedup_hla_5m", _CLOSED_5M)
def stream_dedup_hla_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5-minute job with repeated ticks dropped within the watermark
    (``dropDuplicatesWithinWatermark`` on symbol, target and event time);
    ``events`` holds no repeats, so the result equals the plain job's."""
    from ticksmith.sources.tables import read_windowed

    return read_windowed(spark, run_stream_job(spark, sf_dir, "5 minutes", HLA, "dedup_hla_5m", dedup=True))


# --------------------------------------------------------------------------
# JSON tick codec
# --------------------------------------------------------------------------

_TICK_ROWS_MS = """
SELECT event_type AS "from", 'EUR' AS "to", date_trunc('millisecond', ts) AS "timestamp", value AS rate
FROM events
""".strip()


@register("json_roundtrip", _TICK_ROWS_MS)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks -> JSON message value -> parsed back (cast, from_json, flatten)."""
    from pyspark.sql import functions as F

    from ticksmith.functions.ticks_json import tag_ticks, tick_json
    from ticksmith.operators.quality import split

    msgs = _ticks(spark, sf_dir).select(tick_json().cast("binary").alias("value"))
    good, _ = split(tag_ticks(msgs))
    return good.select("from", "to", _ntz(F.col("timestamp")).alias("timestamp"), "rate")


@register(
    "null_time_dropped",
    duck_tumbling_sql(
        "1 hour",
        HLA,
        where=f"TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) >= {BAD_TIME_BELOW_K}",
    ),
)
def null_time_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose event time does not parse never open a window."""
    from pyspark.sql import functions as F

    from ticksmith.functions.ticks_json import parse_ticks, tick_json
    from ticksmith.operators.tumbling import tumbling

    ticks = _ticks(spark, sf_dir, keep=("props",))
    k = F.get_json_object("props", "$.k").try_cast("int")
    ts_text = F.when(k >= BAD_TIME_BELOW_K, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).otherwise(
        F.lit(BAD_TIME_TEXT)
    )
    msgs = ticks.select(tick_json("from", "to", ts_text, "rate").alias("value"))
    return tumbling(parse_ticks(msgs), "1 hour", HLA)


@register(
    "tick_quarantine",
    f"""
SELECT event_type AS "from", 'missing or unparseable timestamp' AS reason, count(*) AS n
FROM events
WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) < {BAD_TIME_BELOW_K}
GROUP BY 1, 2
""".strip(),
)
def tick_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad tick messages set aside with a reason, counted per symbol and reason."""
    from pyspark.sql import functions as F

    from ticksmith.functions.ticks_json import tag_ticks, tick_json
    from ticksmith.operators.quality import split

    ticks = _ticks(spark, sf_dir, keep=("props",))
    k = F.get_json_object("props", "$.k").try_cast("int")
    ts_text = F.when(k >= BAD_TIME_BELOW_K, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")).otherwise(
        F.lit(BAD_TIME_TEXT)
    )
    msgs = ticks.select(tick_json("from", "to", ts_text, "rate").alias("value"))
    _, bad = split(tag_ticks(msgs))
    return bad.groupBy("from", "reason").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# Raw quote responses -> ticks -> keyed messages
# --------------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str):
    from pyspark.sql import functions as F

    from ticksmith.sources.responses import land_responses

    return land_responses(_ticks(spark, sf_dir), failed=F.col("from") == F.lit(FAILED_SYMBOL))


def _flattened(spark: SparkSession, sf_dir: str):
    from ticksmith.functions.quotes import flatten_requested

    return flatten_requested(_landed(spark, sf_dir))


@register("quote_flatten", _TICK_ROWS_MS + f"\nWHERE event_type <> '{FAILED_SYMBOL}'")
def quote_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses -> status check -> data[symbol][0].quote[currency] -> tick."""
    from pyspark.sql import functions as F

    from ticksmith.operators.quality import split

    good, _ = split(_flattened(spark, sf_dir))
    return good.select("from", "to", _ntz(F.col("timestamp")).alias("timestamp"), "rate")


@register("quote_flatten_all", _TICK_ROWS_MS + f"\nWHERE event_type <> '{FAILED_SYMBOL}'")
def quote_flatten_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses without the request attached: every (symbol, currency) quote in
    each document is exploded out (first array element only)."""
    from pyspark.sql import functions as F

    from ticksmith.functions.quotes import flatten_all
    from ticksmith.operators.quality import split

    good, _ = split(flatten_all(_landed(spark, sf_dir).select("body")))
    return good.select("from", "to", _ntz(F.col("timestamp")).alias("timestamp"), "rate")


@register(
    "quote_quarantine",
    f"""
SELECT event_type AS "from", 'EUR' AS "to", 'API error: This API Key is invalid.' AS reason,
       ts AS requested_at
FROM events WHERE event_type = '{FAILED_SYMBOL}'
""".strip(),
)
def quote_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses set aside (error status), each with its reason; nothing throws."""
    from pyspark.sql import functions as F

    from ticksmith.functions.quotes import flatten_requested
    from ticksmith.operators.quality import split
    from ticksmith.sources.responses import land_responses

    ticks = _ticks(spark, sf_dir).withColumn("requested_at", _ntz(F.col("timestamp")))
    landed = land_responses(ticks, failed=F.col("from") == F.lit(FAILED_SYMBOL), keep=("requested_at",))
    _, bad = split(flatten_requested(landed, keep=("requested_at",)), good_columns=None)
    return bad.select("from", "to", "reason", "requested_at")


@register(
    "kafka_frame",
    f"""
SELECT event_type || '_EUR' AS key,
       '{{"from":"' || event_type || '","to":"EUR","timestamp":"'
         || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","rate":' || CAST(value AS VARCHAR) || '}}' AS value
FROM events WHERE event_type <> '{FAILED_SYMBOL}'
""".strip(),
)
def kafka_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened quotes as keyed messages (key <SYM>_EUR, flat JSON value with the
    quote's last_updated text copied verbatim)."""
    from ticksmith.operators.quality import split
    from ticksmith.sinks.messages import message_frame

    good, _ = split(_flattened(spark, sf_dir), good_columns=("from", "to", "timestamp_text", "rate"))
    return message_frame(good, ts_col="timestamp_text")


@register(
    "request_grid",
    """
SELECT event_type AS symbol, 'EUR' AS currency, event_type || '_EUR' AS key,
       printf('https://quotes.invalid/v2/quotes/latest?symbol=%s&convert=%s',
              replace(event_type, ' ', '%20'), 'EUR') AS url
FROM (SELECT DISTINCT event_type FROM events UNION ALL SELECT DISTINCT 'new ' || event_type || ' x y' FROM events)
""".strip(),
)
def request_grid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct symbol, and one with spaces beside it, x target currency, with message key and request URL."""
    from pyspark.sql import functions as F

    from ticksmith.sources.events import read_table
    from ticksmith.sources.grid import request_grid

    symbols = read_table(spark, sf_dir, "events").select("event_type").distinct()
    spaced = symbols.select(F.concat(F.lit("new "), F.col("event_type"), F.lit(" x y")).alias("event_type"))
    return request_grid(symbols.unionByName(spaced), symbol_col="event_type")


@register(
    "symbol_filter",
    f"""
SELECT event_type AS "from", 'EUR' AS "to", ts AS "timestamp", value AS rate
FROM events WHERE event_type IN ({", ".join(f"'{s}'" for s in WATCHED)})
""".strip(),
)
def symbol_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only ticks of the watched symbols (an In predicate pushed to the scan)."""
    from pyspark.sql import functions as F

    from ticksmith.operators.filters import symbols_in

    return symbols_in(_ticks(spark, sf_dir), WATCHED).select(
        "from", "to", _ntz(F.col("timestamp")).alias("timestamp"), "rate"
    )


@register(
    "quote_quarantine_counts",
    f"""
SELECT 'API error: This API Key is invalid.' AS reason, count(*) AS n
FROM events WHERE event_type = '{FAILED_SYMBOL}'
""".strip(),
)
def quote_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine size per reason."""
    from ticksmith.operators.quality import reason_counts, split

    _, bad = split(_flattened(spark, sf_dir), good_columns=None)
    return reason_counts(bad)


# Responses as text, of every kind that a service may send, by the payload field k of the event.
_K = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"
_REASONS_SQL = f"""
WITH kinds AS (
  SELECT event_type AS sym, value, CASE {_K}
    WHEN 1 THEN 'data.' || event_type || ' not found' WHEN 2 THEN 'quote.EUR not found' WHEN 3 THEN 'data.' || event_type || ' is empty'
    WHEN 4 THEN 'price missing or not a number' WHEN 5 THEN 'price missing or not a number' WHEN 6 THEN 'price missing or not a number'
    WHEN 7 THEN 'last_updated missing' WHEN 8 THEN 'last_updated is not a timestamp' WHEN 9 THEN 'API error: no "plan" for {{this}}'
    WHEN 10 THEN 'API error: ' WHEN 12 THEN 'API error: unknown response format' WHEN 13 THEN 'API error: unknown response format'
    WHEN 14 THEN 'empty response' WHEN 15 THEN 'API error: ' WHEN 16 THEN 'requested symbol or currency unknown' ELSE 'good' END AS reason,
    {_K} AS k
  FROM events
)
SELECT CASE WHEN k = 16 THEN '' ELSE sym END AS "from", reason, count(*) AS n,
       max(CASE WHEN reason = 'good' THEN value ELSE -1 END) AS highest
FROM kinds GROUP BY ALL"""


def _odd_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``symbol, currency, body, k`` for each event, the document written here as text."""
    from pyspark.sql import functions as F

    rows = _ticks(spark, sf_dir, keep=("props",))
    k = F.get_json_object("props", "$.k").try_cast("int")
    sym, price = F.col("from"), F.col("rate").cast("string")
    at = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    ok = '{"status": {"error_code": 0, "error_message": null}, "data": {"%s": [%s]}}'
    quote = '{"quote": {"%s": {"price": %s, "last_updated": %s}}}'

    def doc(symbol, entries):
        return F.format_string(ok, symbol, entries)

    def entry(p, updated, currency="EUR"):
        return F.format_string(quote, F.lit(currency), p, updated)

    stamp = F.concat(F.lit('"'), at, F.lit('"'))
    good = doc(sym, entry(price, stamp))
    bodies = {
        0: F.replace(good, F.lit('"error_code": 0'), F.lit('"error_code": "0"')),
        1: doc(F.lit("OTHER"), entry(price, stamp)),
        2: doc(sym, entry(price, stamp, "XYZ")),
        3: doc(sym, F.lit("")),
        4: doc(sym, entry(F.lit("null"), stamp)),
        5: doc(sym, entry(F.concat(F.lit('"'), price, F.lit('"')), stamp)),
        6: doc(sym, entry(F.lit("NaN"), stamp)),
        7: doc(sym, entry(price, F.lit("null"))),
        8: doc(sym, entry(price, F.lit('"soon"'))),
        9: F.lit('{"status": {"error_code": 400, "error_message": "no \\"plan\\" for {this}"}}'),
        10: F.lit('{"status": {"error_code": 500}}'),
        11: doc(sym, F.concat(entry(price, stamp), F.lit(", "), entry(F.lit("1e9"), stamp))),  # the second does not count
        12: F.lit("502 Bad Gateway"),
        13: F.regexp_replace(good, '"status": [{][^}]*[}], ', ""),
        14: F.lit(None).cast("string"),
        15: F.lit('{"status": {"error_code": "7", "error_message": null}, "data": null}'),
    }
    body = good
    for n, text in bodies.items():
        body = F.when(k == n, text).otherwise(body)
    return rows.select(F.when(k == 16, F.lit("")).otherwise(sym).alias("symbol"), F.col("to").alias("currency"), body.alias("body"), k.alias("k"))


@register("quote_reasons", _REASONS_SQL)
def quote_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many responses of each symbol were taken or set aside, for which reason, and the highest price taken."""
    from ticksmith.functions.quotes import flatten_requested

    return _by_reason(flatten_requested(_odd_responses(spark, sf_dir)))


def _by_reason(tagged: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    reason = F.coalesce("_reason", F.lit("good"))
    return tagged.groupBy(F.coalesce("from", F.lit("")).alias("from"), reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("_reason").isNull(), F.col("rate")).otherwise(-1.0)).alias("highest"))


@register("publish_to_files", f"""
SELECT event_type || '_EUR' AS key,
       '{{"from":"' || event_type || '","to":"EUR","timestamp":"'
         || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","rate":' || CAST(value AS VARCHAR) || '}}' AS value
FROM events WHERE {_K} NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 15)
UNION ALL
SELECT 'OTHER_EUR', '{{"from":"OTHER","to":"EUR","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","rate":' || CAST(value AS VARCHAR) || '}}'
FROM events WHERE {_K} = 1
UNION ALL
SELECT event_type || '_XYZ', '{{"from":"' || event_type || '","to":"XYZ","timestamp":"'
         || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","rate":' || CAST(value AS VARCHAR) || '}}'
FROM events WHERE {_K} = 2""")
def publish_to_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The producer as a streaming job: responses landed as JSON lines -> keyed messages in files."""
    from pyspark.sql import functions as F

    from ticksmith.session import shared_path
    from ticksmith.sources.responses import read_landed
    from ticksmith.streaming.jobs import start_publish_job

    run = shared_path(spark, "app", "publish")
    landing = _land_text(_odd_responses(spark, sf_dir).select(F.coalesce("body", F.lit("")).alias("body")), f"{run}/landing")
    q = start_publish_job(read_landed(spark, landing, streaming=True, one_document_per_file=False), {"path": f"{run}/messages"},
                          f"{run}/checkpoint", fmt="json", trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.schema("key string, value string").json(f"{run}/messages")


@register("responses_multi", f"""
WITH kinds AS (
  SELECT CASE WHEN {_K} = 1 THEN 'OTHER' WHEN {_K} IN (9, 10, 12, 13, 15) THEN '' ELSE event_type END AS "from", value, CASE {_K}
    WHEN 3 THEN 'data.' || event_type || ' is empty' WHEN 4 THEN 'price missing or not a number' WHEN 5 THEN 'price missing or not a number'
    WHEN 6 THEN 'price missing or not a number' WHEN 7 THEN 'last_updated missing' WHEN 8 THEN 'last_updated is not a timestamp'
    WHEN 9 THEN 'API error: no "plan" for {{this}}' WHEN 10 THEN 'API error: ' WHEN 12 THEN 'API error: unknown response format'
    WHEN 13 THEN 'API error: unknown response format' WHEN 15 THEN 'API error: ' ELSE 'good' END AS reason
  FROM events WHERE {_K} <> 14
)
SELECT "from", reason, count(*) AS n, max(CASE WHEN reason = 'good' THEN value ELSE -1 END) AS highest FROM kinds GROUP BY ALL""")
def responses_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of hundreds of responses, one after another on one line, each its own row again; counts by symbol and reason."""
    from pyspark.sql import functions as F

    from ticksmith.functions.quotes import flatten_all
    from ticksmith.session import shared_path
    from ticksmith.sources.responses import read_landed

    path = shared_path(spark, "app", "multi")
    body = F.when(F.col("k") == 12, F.lit('["502 Bad Gateway"]')).otherwise(F.col("body")).alias("body")
    _odd_responses(spark, sf_dir).select(body).where("body IS NOT NULL").write.option("lineSep", " ").option("maxRecordsPerFile", 400).text(path)
    return _by_reason(flatten_all(read_landed(spark, path).select("body")))


# --------------------------------------------------------------------------
# Read side: dashboard panels over windowed tables
# --------------------------------------------------------------------------


def _panel_where(width: str, aggs: dict) -> str:
    return (
        f"SELECT * FROM ({duck_tumbling_sql(width, aggs)}) w "
        f"WHERE from_currency = '{PANEL_COIN}' "
        f"AND window_start BETWEEN TIMESTAMP '{PANEL_START}' AND TIMESTAMP '{PANEL_NOW}'"
    )


def _windowed_range(spark, sf_dir, width, aggs):
    from ticksmith.plans.serve import windowed_for_range

    return windowed_for_range(
        lambda since, until: _ticks(spark, sf_dir, since=since, until=until),
        width,
        aggs,
        PANEL_START,
        PANEL_NOW,
        coin=PANEL_COIN,
    )


def _range():
    import datetime as dt

    from ticksmith.plans.serve import last

    return last(PANEL_LOOKBACK, now=dt.datetime.fromisoformat(PANEL_NOW))


@register(
    "panel_price_1m",
    f"SELECT from_currency AS currency, rate, window_start AS time FROM ({_panel_where('1 minute', PRICE)})",
)
def panel_price_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ticksmith.plans.serve import price_series

    start, end = _range()
    return price_series(_windowed_range(spark, sf_dir, "1 minute", PRICE), PANEL_COIN, start, end)


for _w, _tag in (("5 minutes", "5m"), ("10 minutes", "10m")):

    def _hl(spark, sf_dir, _w=_w):
        from ticksmith.plans.serve import high_low_series

        start, end = _range()
        return high_low_series(_windowed_range(spark, sf_dir, _w, HLA), PANEL_COIN, start, end)

    def _mam(spark, sf_dir, _w=_w):
        from ticksmith.plans.serve import min_avg_max_series

        start, end = _range()
        return min_avg_max_series(_windowed_range(spark, sf_dir, _w, HLA), PANEL_COIN, start, end)

    register(
        f"panel_high_low_{_tag}",
        "SELECT from_currency AS currency, high_rate AS high, low_rate AS low, window_start AS time "
        f"FROM ({_panel_where(_w, HLA)})",
    )(_hl)
    register(
        f"panel_min_avg_max_{_tag}",
        "SELECT from_currency AS currency, low_rate AS minimum, avg_rate AS average, "
        f"high_rate AS maximum, window_start AS time FROM ({_panel_where(_w, HLA)})",
    )(_mam)


@register(
    "panel_sql_high_low_5m",
    "SELECT from_currency AS currency, high_rate AS high, low_rate AS low, window_start AS time "
    f"FROM ({_panel_where('5 minutes', HLA)})",
)
def panel_sql_high_low_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The high/low panel as Spark SQL text with named parameters over a view."""
    import uuid

    from ticksmith.plans.panel_sql import run_panel

    view = f"rate_5min_{uuid.uuid4().hex[:8]}"
    _windowed_range(spark, sf_dir, "5 minutes", HLA).createOrReplaceTempView(view)
    start, end = _range()
    return run_panel(spark, "high_low", view, PANEL_COIN, start, end)


@register(
    "coin_list",
    "SELECT DISTINCT event_type AS from_currency FROM events WHERE ts IS NOT NULL AND value IS NOT NULL",
)
def coin_list_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct coins of the 1-minute table."""
    from ticksmith.operators.tumbling import tumbling
    from ticksmith.plans.serve import coin_list

    return coin_list(tumbling(_ticks(spark, sf_dir), "1 minute", PRICE))


@register(
    "panel_order_5m",
    "SELECT currency, high, low, time, row_number() OVER (ORDER BY time, currency) - 1 AS position FROM ("
    f"SELECT from_currency AS currency, high_rate AS high, low_rate AS low, window_start AS time FROM ({duck_tumbling_sql('5 minutes', HLA)}) w)",
)
def panel_order_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The high/low rows of all coins, each with its place in the order of time and currency."""
    from pyspark.sql import functions as F

    from ticksmith.operators.ordering import positioned
    from ticksmith.operators.tumbling import tumbling

    rows = tumbling(_ticks(spark, sf_dir), "5 minutes", HLA).select(
        F.col("from_currency").alias("currency"), F.col("high_rate").alias("high"), F.col("low_rate").alias("low"), F.col("window_start").alias("time"))
    return positioned(rows, ["time", "currency"])


@register(
    "coin_list_order",
    "SELECT from_currency, row_number() OVER (ORDER BY from_currency) - 1 AS position FROM ("
    "SELECT DISTINCT event_type AS from_currency FROM events WHERE ts IS NOT NULL AND value IS NOT NULL)",
)
def coin_list_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's coins, each with its place in the list."""
    from ticksmith.operators.ordering import positioned

    return positioned(coin_list_query(spark, sf_dir), ["from_currency"])


# --------------------------------------------------------------------------
# Sinks: contract, idempotent keyed append, stored-table scans, TSV load
# --------------------------------------------------------------------------


@register("sink_contract", duck_tumbling_sql("5 minutes", HLA))
def sink_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5-minute aggregate cast to the sink schema; violators split off."""
    from ticksmith.operators.tumbling import tumbling
    from ticksmith.schema import SINK_HLA
    from ticksmith.sinks.contract import conform

    ok, _ = conform(tumbling(_ticks(spark, sf_dir), "5 minutes", HLA), SINK_HLA)
    return ok


@register("idempotent_append", duck_tumbling_sql("5 minutes", HLA))
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the same batch twice through the keyed sink; the table is unchanged."""
    from ticksmith.operators.tumbling import tumbling
    from ticksmith.session import shared_path
    from ticksmith.sinks.keyed import KeyedTable

    sink = KeyedTable(shared_path(spark, "sink", "hla_5m"))
    batch = tumbling(_ticks(spark, sf_dir), "5 minutes", HLA).persist()
    try:
        sink.append_new(batch, 0)
        sink.append_new(batch, 0)  # replay of the same batch id
    finally:
        batch.unpersist()
    return sink.read(spark)


# Two overlapping batches of windows: those before the 20th day, and those from the 10th day on, in which
# purchases before the 20th day have other values, clicks stand twice and sign-ups of the last day have two versions.
_DAY = "(SELECT date_trunc('day', min(ts)) FROM events) + INTERVAL {} DAY"
_LAST_DAY = "(SELECT date_trunc('day', max(ts)) FROM events)"
_KEYED_SQL = f"""
WITH first AS ({duck_tumbling_sql("5 minutes", HLA, where=f"ts < {_DAY.format(20)}")}
), fresh AS (
  SELECT ts, event_type, CASE WHEN event_type = 'purchase' AND ts < {_DAY.format(20)} THEN value * 2 ELSE value END AS value
  FROM events WHERE ts >= {_DAY.format(10)}
), plain AS ({duck_tumbling_sql("5 minutes", HLA, source="fresh")}
), second AS (
  SELECT *, from_currency = 'signup' AND window_start >= {_LAST_DAY} AS two FROM plain
)"""
_SAME = "f.window_start = s.window_start AND f.from_currency = s.from_currency AND f.to_currency = s.to_currency"


def _two_batches(spark: SparkSession, sf_dir: str):
    """The keyed table and its conflicts after both batches."""
    import datetime as dt

    from pyspark.sql import functions as F

    from ticksmith.operators.tumbling import tumbling
    from ticksmith.session import shared_path
    from ticksmith.sinks.keyed import KeyedTable, QuarantineTable
    from ticksmith.sources.events import read_table

    run = shared_path(spark, "sink", "conflicts")
    lo, hi = read_table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    start, last = (t.replace(hour=0, minute=0, second=0, microsecond=0) if t else dt.datetime(1970, 1, 1) for t in (lo, hi))
    early, late = start + dt.timedelta(days=10), start + dt.timedelta(days=20)
    fresh = _ticks(spark, sf_dir, since=early)
    changed = (F.col("from") == "purchase") & (_ntz(F.col("timestamp")) < F.lit(late.isoformat(sep=" ")).cast("timestamp_ntz"))
    plain = tumbling(fresh.withColumn("rate", F.when(changed, F.col("rate") * 2).otherwise(F.col("rate"))), "5 minutes", HLA)
    twice = plain.where((F.col("from_currency") == "signup") & (F.col("window_start") >= F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz")))
    second = plain.unionByName(plain.where(F.col("from_currency") == "click")).unionByName(twice.withColumn("high_rate", F.col("high_rate") + 1))
    sink = KeyedTable(f"{run}/rate_5min", conflicts=QuarantineTable(f"{run}/conflicts"))
    for i, batch in enumerate((tumbling(_ticks(spark, sf_dir, until=late), "5 minutes", HLA), second)):
        batch = batch.persist()
        try:
            sink.append_new(batch, i)
            sink.append_new(batch, i)  # and replayed
        finally:
            batch.unpersist()
    return sink


@register("duplicate_keys", _KEYED_SQL + f"""
SELECT * FROM first
UNION ALL
SELECT * EXCLUDE (two) FROM second s WHERE NOT two AND NOT EXISTS (SELECT 1 FROM first f WHERE {_SAME})""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after two overlapping batches: every undisputed key once, as it was first stored."""
    return _two_batches(spark, sf_dir).read(spark)


@register("duplicate_keys_conflicts", _KEYED_SQL + f"""
SELECT s.* EXCLUDE (two), 'differs from the stored row' AS reason, CAST(1 AS BIGINT) AS batch_id
FROM second s JOIN first f ON {_SAME}
WHERE (s.high_rate, s.low_rate, s.avg_rate) IS DISTINCT FROM (f.high_rate, f.low_rate, f.avg_rate)
UNION ALL
SELECT window_start, window_end, from_currency, to_currency, high_rate + plus, low_rate, avg_rate, 'differs within the batch', 1
FROM second, (VALUES (0), (1)) v(plus) WHERE two""")
def duplicate_keys_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the second batch that are not stored, as another row has their key."""
    sink = _two_batches(spark, sf_dir)
    return sink.conflicts.read(spark).drop("query_id").withColumn("batch_id", _long("batch_id"))


def _long(name: str):
    from pyspark.sql import functions as F

    return F.col(name).cast("long")


@register(
    "stored_panel_price_1m",
    f"SELECT from_currency AS currency, rate, window_start AS time FROM ({_panel_where('1 minute', PRICE)})",
)
def stored_panel_price_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price panel read from the stored 1-minute table (date-partition pruning)."""
    from ticksmith.operators.tumbling import tumbling
    from ticksmith.plans.serve import price_series
    from ticksmith.session import shared_path
    from ticksmith.sinks.keyed import KeyedTable

    sink = KeyedTable(shared_path(spark, "sink", "avg_1m"))
    sink.backfill(tumbling(_ticks(spark, sf_dir), "1 minute", PRICE))
    start, end = _range()
    return price_series(sink.read_range(spark, start, end), PANEL_COIN, start, end)


@register("backfill_rollup_10m", duck_tumbling_sql("10 minutes", HLA))
def backfill_rollup_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-minute table rebuilt from staged 1-minute partials (one tick scan for
    every width); the mean comes from the exact sums of the partials."""
    from ticksmith.config import DEFAULT_JOBS
    from ticksmith.plans.backfill import rolled_up

    return rolled_up(_ticks(spark, sf_dir), DEFAULT_JOBS)["10min"]


@register("tsv_load", duck_tumbling_sql("10 minutes", HLA))
def tsv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-minute rows written as COPY text (tab separated, \\N nulls) and loaded back."""
    from ticksmith.operators.tumbling import tumbling
    from ticksmith.schema import SINK_HLA
    from ticksmith.session import shared_path
    from ticksmith.sources.tsv import load_copy_text, write_copy_text

    path = shared_path(spark, "tsv", "hla_10m")
    write_copy_text(tumbling(_ticks(spark, sf_dir), "10 minutes", HLA), path)
    good, _ = load_copy_text(spark, path, SINK_HLA)
    return good


# Two kinds of dump blocks, by the date: columns in the order of the schema, or turned round and quoted.  Purchases
# have no window end, and a note holds tabs, line ends and backslashes.
_NOTE_SQL = "from_currency || chr(9) || 'a\\b' || chr(10) || chr(92) || 'N ' || strftime(window_start, '%H:%M')"


@register("dump_block_load", f"""
SELECT window_start, CASE WHEN from_currency <> 'purchase' THEN window_end END AS window_end, from_currency, to_currency, rate,
       {_NOTE_SQL} AS note
FROM ({duck_tumbling_sql("10 minutes", PRICE)}) w""")
def dump_block_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-minute means written as dumps, with a block for each date among blocks of another table, and loaded back."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from ticksmith.operators.tumbling import tumbling
    from ticksmith.schema import SINK_PRICE
    from ticksmith.session import shared_path
    from ticksmith.sources.tsv import copy_lines, load_copy_dump

    schema = T.StructType([*SINK_PRICE.fields, T.StructField("note", T.StringType())])
    note = F.concat("from_currency", F.lit("\ta\\b\n\\N "), F.date_format("window_start", "HH:mm"))
    rows = tumbling(_ticks(spark, sf_dir), "10 minutes", PRICE).withColumns(
        {"window_end": F.when(F.col("from_currency") != "purchase", F.col("window_end")), "note": note, "day": F.to_date("window_start")})
    names = schema.fieldNames()
    turned = F.dayofmonth("day") % 2 == 0
    lines = [
        copy_lines(part.select("day", *columns), keep=("day",)).withColumn("place", F.lit(3))
        for part, columns in ((rows.where(~turned), names), (rows.where(turned), names[::-1]))]
    headers = (f"COPY public.rate_10min ({', '.join(names)}) FROM stdin;",
               "COPY rate_10min (" + ", ".join(f'"{n}"' for n in names[::-1]) + ") FROM stdin;")
    days = rows.select("day").distinct()
    # a block of another table, in which a line looks like a header
    around = [(0, F.lit("COPY public.notes (day, note) FROM stdin;")), (1, F.lit(headers[0] + "\tx")), (1, F.lit(headers[0])), (2, F.lit("\\.")),
              (2.5, F.when(turned, F.lit(headers[1])).otherwise(F.lit(headers[0]))), (4, F.lit("\\.")), (5, F.lit("-- end"))]
    out = lines[0].unionByName(lines[1])
    for place, value in around:
        out = out.unionByName(days.select("day", value.alias("value"), F.lit(place).alias("place")))
    path = shared_path(spark, "dump", "rate_10min")
    # whole dates to a file, several of them in most
    out.repartition(4, "day").sortWithinPartitions("day", "place").select("value").write.text(path)
    return load_copy_dump(spark, path, "rate_10min", schema)[0]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from ticksmith.config import DEFAULT_JOBS, HLA, PRICE, WindowSpec
from ticksmith.session import shared_path
from ticksmith.sources.landing import read_messages
from ticksmith.streaming.jobs import start_message_jobs

from conftest import SMOKE_DIR, ts


def msg(t, rate, sym="BTC"):
    return json.dumps({"from": sym, "to": "EUR", "timestamp": f"2025-06-19T12:{t}Z", "rate": rate})


def land(folder, idx, lines):
    path = os.path.join(folder, f"part-{idx:03d}.jsonl")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + idx * 10, 1_700_000_000 + idx * 10))


def run_once(spark, landing, tables, ckpt, specs):
    msgs = read_messages(spark, landing, max_files_per_trigger=1)
    group = start_message_jobs(msgs, specs, tables, ckpt, trigger={"availableNow": True})
    group.await_all(timeout=300)
    return group


def rows_1m(spark, tables):
    df = spark.read.parquet(f"{tables}/rate_1min").drop("window_date")
    return {r.window_start.strftime("%H:%M"): round(r.rate, 3) for r in df.collect()}


def test_late_data_script_and_restart(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    run = shared_path(spark, "test-late")
    tables, ckpt = f"{run}/tables", f"{run}/checkpoints"
    specs = [DEFAULT_JOBS[0]]  # 1-minute windows, 1-minute watermark
    land(landing, 0, [msg("00:10", 1), msg("00:50", 3)])
    land(landing, 1, [msg("02:00", 7), "not json at all"])
    land(landing, 2, [msg("00:30", 100)])  # late but counted: its window is due in this batch
    land(landing, 3, [msg("00:40", 500), msg("01:30", 4)])  # 00:40 dropped, 01:30 kept
    land(landing, 4, [msg("05:00", 2)])
    group = run_once(spark, landing, tables, ckpt, specs)
    assert rows_1m(spark, tables) == {"12:00": 34.667, "12:01": 4.0, "12:02": 7.0}
    assert group.dropped_late_rows()["1min"] == 1
    q = spark.read.parquet(f"{tables}/quarantine").collect()
    assert [(r.reason, r.raw) for r in q] == [("not a tick object", "not json at all")]

    # restart from the same checkpoint: the open 12:05 window was kept in state
    land(landing, 6, [msg("08:00", 2)])
    run_once(spark, landing, tables, ckpt, specs)
    assert rows_1m(spark, tables) == {"12:00": 34.667, "12:01": 4.0, "12:02": 7.0, "12:05": 2.0}


def test_fan_out_three_widths(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    run = shared_path(spark, "test-fanout")
    lines = [msg(f"{m:02d}:{s:02d}", float(m + 1), sym) for m in range(0, 25) for s in (5, 35) for sym in ("BTC", "ETH")]
    land(landing, 0, lines)
    run_once(spark, landing, f"{run}/tables", f"{run}/checkpoints", DEFAULT_JOBS)
    r1 = spark.read.parquet(f"{run}/tables/rate_1min")
    r5 = spark.read.parquet(f"{run}/tables/rate_5min")
    r10 = spark.read.parquet(f"{run}/tables/rate_10min")
    # max event time 12:24:35: closed windows end <= max - delay
    assert r1.count() == 2 * 23  # 12:00..12:22 (end 12:23 <= 12:23:35)
    assert r5.count() == 2 * 3  # 12:00, 12:05, 12:10 (end <= 12:19:35)
    assert r10.count() == 2 * 1  # 12:00 (end 12:10 <= 12:14:35)
    first5 = r5.where("from_currency = 'BTC' AND window_start = '2025-06-19 12:00:00'").first()
    assert (first5.high_rate, first5.low_rate, first5.avg_rate) == (5.0, 1.0, 3.0)


def test_stream_equals_batch_on_closed_windows(spark):
    from ticksmith.operators.tumbling import closed_windows, tumbling
    from ticksmith.plans.registry import run_stream_job
    from ticksmith.sources.events import read_ticks

    path = run_stream_job(spark, SMOKE_DIR, "5 minutes", HLA, "parity")
    from ticksmith.sources.tables import read_windowed

    streamed = read_windowed(spark, path)
    ticks = read_ticks(spark, SMOKE_DIR)
    max_time = ticks.select(F.max("timestamp").cast("timestamp_ntz")).scalar()
    batch = closed_windows(tumbling(ticks, "5 minutes", HLA), max_time, "5 minutes")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed).count() == 0


def test_replayed_batch_changes_nothing(spark):
    from ticksmith.operators.tumbling import tumbling
    from ticksmith.sinks.keyed import KeyedTable
    from ticksmith.sources.events import read_ticks

    agg = tumbling(read_ticks(spark, SMOKE_DIR), "10 minutes", HLA).persist()
    sink = KeyedTable(shared_path(spark, "test-replay"))
    first_half = agg.where("window_start < '2024-01-15'")
    sink.append_new(first_half, 0)
    n0 = sink.read(spark).count()
    sink.append_new(first_half, 0)  # replay
    assert sink.read(spark).count() == n0
    sink.append_new(agg, 1)  # overlapping batch: only new keys go in
    out = sink.read(spark)
    assert out.count() == agg.count()
    assert out.groupBy("window_start", "from_currency", "to_currency").count().where("count > 1").count() == 0
    agg.unpersist()


def test_live_trigger_emits_as_watermark_advances(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    run = shared_path(spark, "test-live")
    land(landing, 0, [msg("00:10", 1), msg("00:50", 3)])
    group = start_message_jobs(read_messages(spark, landing), [DEFAULT_JOBS[0]], f"{run}/tables",
                               f"{run}/checkpoints", trigger={"processingTime": "1 second"}, quarantine=False)
    q = group.queries["1min"]

    def emitted(expected, timeout=60):
        # a due window comes out in the no-data batch that follows the data
        # batch; poll (bounded) instead of assuming when that batch runs
        deadline = time.monotonic() + timeout
        while True:
            q.processAllAvailable()
            try:
                got = rows_1m(spark, f"{run}/tables")
            except Exception:  # table not written yet
                got = {}
            if got == expected or time.monotonic() > deadline:
                return got
            time.sleep(0.5)

    try:
        q.processAllAvailable()
        land(landing, 1, [msg("02:30", 7)])  # watermark -> 12:01:30: the 12:00 window is due
        assert emitted({"12:00": 2.0}) == {"12:00": 2.0}
        land(landing, 2, [msg("04:10", 5)])  # watermark -> 12:03:10: 12:02 due
        assert emitted({"12:00": 2.0, "12:02": 7.0}) == {"12:00": 2.0, "12:02": 7.0}
    finally:
        group.stop_all()


def test_window_is_emitted_when_watermark_equals_its_end(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    run = shared_path(spark, "test-equal")
    # max event time 12:02:00 -> watermark 12:01:00 == end of the 12:00 window
    land(landing, 0, [msg("00:10", 1), msg("01:20", 5), msg("02:00", 9)])
    run_once(spark, landing, f"{run}/tables", f"{run}/checkpoints", [DEFAULT_JOBS[0]])
    assert rows_1m(spark, f"{run}/tables") == {"12:00": 1.0}  # 12:01 (end 12:02 > 12:01) stays open

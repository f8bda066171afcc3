import json
import os

import pytest

from ticksmith.config import DEFAULT_JOBS
from ticksmith.session import shared_path
from ticksmith.sources.landing import read_messages
from ticksmith.streaming.jobs import start_message_jobs


def land(folder, name, lines):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def msg(minute, rate):
    return json.dumps({"from": "BTC", "to": "EUR", "timestamp": f"2025-06-19T12:{minute:02d}:05Z", "rate": rate})


def test_app_available_now(spark, tmp_dir):
    from ticksmith.streaming.app import main

    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)
    land(landing, "a.jsonl", [msg(m, float(m)) for m in range(30)])
    run = shared_path(spark, "test-app")
    assert main(["--source", "files", "--path", landing, "--tables", f"{run}/t",
                 "--checkpoints", f"{run}/c", "--available-now"]) == 0
    assert spark.read.parquet(f"{run}/t/rate_1min").count() == 28  # end <= 12:29:05 - 1 min
    assert spark.read.parquet(f"{run}/t/rate_10min").count() == 1


def test_await_any_and_stop_all(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)
    land(landing, "a.jsonl", [msg(0, 1.0)])
    run = shared_path(spark, "test-await")
    group = start_message_jobs(read_messages(spark, landing), DEFAULT_JOBS, f"{run}/t", f"{run}/c",
                               trigger={"processingTime": "1 second"})
    try:
        assert group.await_any(timeout=3) is None  # nothing ends on its own
        assert all(q.isActive for q in group.queries.values())
    finally:
        group.stop_all()
    assert not any(q.isActive for q in group.queries.values())
    assert set(group.queries) == {"1min", "5min", "10min", "quarantine"}


def test_failed_job_is_named(spark, tmp_dir):
    from ticksmith.config import WindowSpec
    from ticksmith.streaming.jobs import JobGroup, start_window_query

    class Boom:
        def append_new(self, batch, batch_id, query_id):
            raise RuntimeError("sink down")

    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)
    land(landing, "a.jsonl", [msg(0, 1.0), msg(5, 2.0)])
    from ticksmith.functions.ticks_json import tag_ticks
    from ticksmith.operators.quality import split

    good, _ = split(tag_ticks(read_messages(spark, landing)))
    run = shared_path(spark, "test-fail")
    q = start_window_query(good, WindowSpec("1min", "1 minute", "1 minute", {"rate": "avg"}), Boom(), f"{run}/c",
                           trigger={"availableNow": True})
    group = JobGroup({"1min": q})
    with pytest.raises(RuntimeError, match="1min"):
        group.await_all(timeout=120)
    with pytest.raises(RuntimeError, match="1min"):
        group.await_any(timeout=120)


def test_sql_panels(spark):
    import datetime as dt

    from ticksmith.plans.panel_sql import run_panel

    rows = [(dt.datetime(2025, 6, 19, 18, m), dt.datetime(2025, 6, 19, 18, m + 5), c, "EUR", 3.0, 1.0, 2.0)
            for m in (0, 5, 10) for c in ("BTC", "DOGE")]
    spark.createDataFrame(
        rows, "window_start timestamp_ntz, window_end timestamp_ntz, from_currency string, to_currency string, "
        "high_rate double, low_rate double, avg_rate double"
    ).createOrReplaceTempView("t5")
    out = run_panel(spark, "min_avg_max", "t5", "DOGE", "2025-06-19 18:05:00", "2025-06-19 18:10:00").collect()
    assert [(r.currency, r.time.minute, r.average) for r in out] == [("DOGE", 5, 2.0), ("DOGE", 10, 2.0)]
    assert [r.from_currency for r in run_panel(spark, "coins", "t5").collect()] == ["BTC", "DOGE"]


def test_app_on_landed_responses(spark, tmp_dir):
    from ticksmith.streaming.app import main

    landing = os.path.join(tmp_dir, "responses")
    os.makedirs(landing)

    def doc(minute, price, code=0):
        d = {"status": {"error_code": code, "error_message": "down" if code else None}}
        if not code:
            d["data"] = {"BTC": [{"quote": {"EUR": {"price": price,
                                                     "last_updated": f"2025-06-19T12:{minute:02d}:30.000Z"}}}]}
        return json.dumps(d)

    for m in range(12):
        with open(os.path.join(landing, f"BTC_EUR-{m:03d}.json"), "w") as fh:
            fh.write(doc(m, float(m), code=1001 if m == 3 else 0))
    run = shared_path(spark, "test-app-resp")
    assert main(["--source", "responses", "--path", landing, "--tables", f"{run}/t",
                 "--checkpoints", f"{run}/c", "--available-now"]) == 0
    r1 = spark.read.parquet(f"{run}/t/rate_1min")
    # minutes 0..9 closed (end <= 12:11:30 - 1 min), minute 3 was an error response
    assert sorted(r.window_start.minute for r in r1.collect()) == [0, 1, 2, 4, 5, 6, 7, 8, 9]
    q = spark.read.parquet(f"{run}/t/quarantine").collect()
    assert [r.reason for r in q] == ["API error: down"]
    r5 = spark.read.parquet(f"{run}/t/rate_5min").where("window_start = '2025-06-19 12:00:00'").first()
    assert (r5.high_rate, r5.low_rate, r5.avg_rate) == (4.0, 0.0, 1.75)


def test_stream_dedup_within_watermark(spark, tmp_dir):
    from ticksmith.config import WindowSpec

    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)
    dup = msg(0, 1.0)
    land(landing, "a.jsonl", [dup, msg(0, 1.0).replace("00:05", "00:06").replace("1.0", "4.0")])
    land(landing, "b.jsonl", [dup, msg(9, 2.0)])  # the same quote polled twice
    run = shared_path(spark, "test-dedup")
    spec = [WindowSpec("1min", "1 minute", "1 minute", {"rate": "avg"})]
    g = start_message_jobs(read_messages(spark, landing, max_files_per_trigger=1), spec, f"{run}/t", f"{run}/c",
                           trigger={"availableNow": True}, dedup=True, quarantine=False)
    g.await_all(timeout=300)
    r = spark.read.parquet(f"{run}/t/rate_1min").where("window_start = '2025-06-19 12:00:00'").first()
    assert r.rate == 2.5  # (1 + 4) / 2: the repeated tick counted once


def test_sink_contract_in_stream(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "in")
    os.makedirs(landing)
    long_sym = json.dumps({"from": "AVERYLONGCOIN", "to": "EUR", "timestamp": "2025-06-19T12:00:05Z", "rate": 1.0})
    land(landing, "a.jsonl", [msg(0, 1.0), long_sym, msg(5, 2.0)])
    run = shared_path(spark, "test-contract")
    spec = [DEFAULT_JOBS[0]]
    g = start_message_jobs(read_messages(spark, landing), spec, f"{run}/t", f"{run}/c",
                           trigger={"availableNow": True}, quarantine=False)
    g.await_all(timeout=300)
    assert [r.from_currency for r in spark.read.parquet(f"{run}/t/rate_1min").collect()] == ["BTC"]
    rej = spark.read.parquet(f"{run}/t/rejects/1min").collect()
    assert [r.reason for r in rej] == ["from_currency longer than 10"]


def test_app_on_a_tick_table(spark):
    from ticksmith.streaming.app import main
    from conftest import SMOKE_DIR

    run = shared_path(spark, "test-app-table")
    assert main(["--source", "table", "--path", SMOKE_DIR, "--table-name", "events", "--tables", f"{run}/t",
                 "--checkpoints", f"{run}/c", "--available-now"]) == 0
    from ticksmith.operators.tumbling import tumbling
    from ticksmith.sources.events import read_ticks
    from pyspark.sql import functions as F

    ticks = read_ticks(spark, SMOKE_DIR)
    max_t = ticks.select(F.max("timestamp").cast("timestamp_ntz")).scalar()
    for name, spec in (("rate_5min", DEFAULT_JOBS[1]), ("rate_10min", DEFAULT_JOBS[2])):
        want = tumbling(ticks, spec.width, spec.aggs).where(F.col("window_end") <= max_t - F.expr(f"INTERVAL {spec.delay}"))
        got = spark.read.parquet(f"{run}/t/{name}").drop("window_date", "query_id", "batch_id")
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0

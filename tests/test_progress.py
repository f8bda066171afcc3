import os

import pytest

from conftest import ORACLE_DIR
from test_streaming import land, msg

from ticksmith.config import DEFAULT_JOBS
from ticksmith.plans import registry
from ticksmith.session import put_text, read_text, shared_path
from ticksmith.sources.landing import read_messages
from ticksmith.streaming.jobs import start_message_jobs
from ticksmith.streaming.progress import read_progress, totals


def run(spark, landing, root, **kw):
    group = start_message_jobs(read_messages(spark, landing, max_files_per_trigger=1), DEFAULT_JOBS[:2], f"{root}/tables", f"{root}/checkpoints",
                               trigger={"availableNow": True}, **kw)
    group.await_all(timeout=300)
    return group


def test_counts_survive_restarts_and_a_short_memory(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), shared_path(spark, "test-progress")
    os.makedirs(landing)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        land(landing, 0, [msg("00:10", 1)])
        land(landing, 1, [msg("20:00", 7)])
        land(landing, 2, [msg("20:10", 7)])  # a watermark holds from the second batch after the one that moved it
        land(landing, 3, [msg("00:30", 100), msg("01:30", 4)])  # late for both jobs: two windows of a minute, one of five
        for k in range(4, 7):
            land(landing, k, [msg(f"{20 + k}:00", 7)])
        assert run(spark, landing, root).dropped_late_rows() == {"1min": 2, "5min": 1, "quarantine": 0}
        land(landing, 8, [msg("00:40", 1)])
        group = run(spark, landing, root)
        assert group.dropped_late_rows() == {"1min": 3, "5min": 2, "quarantine": 0}
        assert all(len(q.recentProgress) <= 2 for q in group.queries.values())
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    rows = {r.name: (r.data_batches, r.input_rows) for r in totals(read_progress(spark, f"{root}/checkpoints/progress")).collect()}
    assert rows["1min"] == rows["5min"] == (8, 9)


def test_nothing_logged_yet(spark):
    assert read_progress(spark, shared_path(spark, "test-progress")).count() == 0


def test_small_files_are_replaced_or_kept_whole(spark):
    path = f"{shared_path(spark, 'test-put')}/a.json"
    assert put_text(spark, path, "one") and put_text(spark, path, "two") and read_text(spark, path) == "two"
    assert not put_text(spark, path, "three", replace=False) and read_text(spark, path) == "two"


def test_reports_of_two_threads_at_once(spark):
    """The listener and a query that is caught up with write the same batches."""
    import threading
    from types import SimpleNamespace

    from ticksmith.streaming.progress import ProgressLog

    log = ProgressLog(spark, shared_path(spark, "test-threads"))
    log.names["q"] = "job"
    reports = [SimpleNamespace(id="q", runId="r", batchId=b, timestamp=f"2024-01-01T00:00:{b:02d}", numInputRows=b, stateOperators=[], eventTime=None)
               for b in range(20)]
    failed = []

    def write():
        try:
            for r in reports:
                log.put(r)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and {(r.batch_id, r.input_rows) for r in log.read().collect()} == {(b, b) for b in range(20)}


def test_the_time_limit_names_what_still_runs(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), shared_path(spark, "test-limit")
    os.makedirs(landing)
    land(landing, 0, [msg("00:10", 1)])
    group = start_message_jobs(read_messages(spark, landing), DEFAULT_JOBS[:1], f"{root}/tables", f"{root}/checkpoints",
                               trigger={"processingTime": "1 second"}, quarantine=False)
    try:
        with pytest.raises(TimeoutError, match="1min"):
            group.await_all(timeout=2)
    finally:
        group.stop_all()


def test_late_windows_differ_from_the_batch_result(spark):
    """The query has late rows that change windows, not only rows that make up whole windows."""
    counts = registry.QUERIES["late_drop_counts"](spark, ORACLE_DIR).first()
    assert counts.data_batches == 4 and counts.input_rows == 10_000 and counts.dropped_rows > 50

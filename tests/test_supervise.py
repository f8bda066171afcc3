import os
import time

from test_streaming import land, msg, rows_1m

from ticksmith.config import DEFAULT_JOBS
from ticksmith.session import shared_path
from ticksmith.sources.landing import read_messages
from ticksmith.streaming.jobs import JobGroup, start_message_jobs


def jobs(spark, tmp_dir, trigger=None, **kw):
    landing, root = os.path.join(tmp_dir, "landing"), shared_path(spark, "test-supervise")
    os.makedirs(landing)
    land(landing, 0, [msg("00:10", 1), msg("00:50", 3), msg("05:00", 1)])
    land(landing, 1, [msg("08:00", 1)])
    return start_message_jobs(read_messages(spark, landing, max_files_per_trigger=1), DEFAULT_JOBS[:1], f"{root}/tables", f"{root}/checkpoints",
                              trigger=trigger, **kw), root


def broken(spark, tmp_dir, failures):
    """A job whose first batches fail."""
    left = [failures]
    rows = []

    def write(batch, batch_id):
        if left[0] > 0:
            left[0] -= 1
            raise RuntimeError("no disk")
        rows.extend(r.value for r in batch.collect())

    source, checkpoint = read_messages(spark, os.path.join(tmp_dir, "landing"), max_files_per_trigger=1), shared_path(spark, "test-supervise")

    def start():
        return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    return start, rows


def test_all_end(spark, tmp_dir):
    group, root = jobs(spark, tmp_dir, {"availableNow": True})
    found = group.supervise(seconds=120)
    assert {n: r.state for n, r in found.items()} == {"1min": "ended", "quarantine": "ended"}
    assert rows_1m(spark, f"{root}/tables")["12:00"] == 2.0


def test_time_is_up_after_the_work_is_done(spark, tmp_dir):
    group, root = jobs(spark, tmp_dir, {"processingTime": "500 milliseconds"})
    found = group.supervise(seconds=8, drain=60)
    assert {r.state for r in found.values()} == {"stopped"} and not any(q.isActive for q in group.queries.values())
    assert rows_1m(spark, f"{root}/tables")["12:00"] == 2.0


def test_a_slow_job_is_late(spark, tmp_dir):
    group, _ = jobs(spark, tmp_dir, {"availableNow": True}, quarantine=False)
    source = read_messages(spark, os.path.join(tmp_dir, "landing"))
    checkpoint = shared_path(spark, "test-supervise")
    group.add("slow", lambda: source.writeStream.foreachBatch(lambda b, i: time.sleep(12)).option("checkpointLocation", checkpoint).start())
    assert group.supervise(seconds=2, drain=1)["slow"].state == "late"
    assert not any(q.isActive for q in group.queries.values())


def test_a_failed_job_starts_again_from_its_checkpoint(spark, tmp_dir):
    jobs(spark, tmp_dir, {"availableNow": True}, quarantine=False)[0].await_all()
    start, rows = broken(spark, tmp_dir, 2)
    group = JobGroup()
    group.add("job", start)
    report = group.supervise(seconds=120, restarts=3)["job"]
    assert (report.state, report.restarts) == ("ended", 2) and "no disk" in report.error
    assert len(rows) == 4  # each message once


def test_one_failure_too_many_stops_the_others(spark, tmp_dir):
    group, _ = jobs(spark, tmp_dir, {"processingTime": "1 second"}, quarantine=False)
    group.add("broken", broken(spark, tmp_dir, 99)[0])
    found = group.supervise(restarts=1)
    assert (found["broken"].state, found["broken"].restarts, found["1min"].state) == ("failed", 1, "stopped")
    assert "no disk" in found["broken"].error

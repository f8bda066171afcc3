import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from test_sinks import hla_rows

from ticksmith.session import list_folders, list_names, shared_path
from ticksmith.sinks import manifest
from ticksmith.sinks.keyed import KeyedTable, QuarantineTable

DAYS = ["2024-11-18", "2024-11-19", "2024-11-20"]


def rows_of_day(day, n, symbols=("BTC", "ETH", "SOL")):
    out = []
    for i in range(n):
        start = dt.datetime.fromisoformat(day) + dt.timedelta(minutes=5 * (i // len(symbols)))
        out.append((str(start), str(start + dt.timedelta(minutes=5)), symbols[i % len(symbols)], "EUR", i + 1.0, i - 1.0, float(i)))
    return out


def frame(spark, *days_and_counts):
    return hla_rows(spark, [r for day, n in days_and_counts for r in rows_of_day(day, n)])


def files(spark, path):
    return [n for n in list_names(spark, path) if n.endswith(".parquet")]


def values(df):
    return sorted(map(tuple, df.collect()))


# -- files ---------------------------------------------------------------------
@pytest.mark.parametrize("adaptive", ["false", "true"])
def test_each_date_has_the_files_its_rows_need(spark, adaptive):
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        sink = KeyedTable(shared_path(spark, "test-files"), by_batch=True, rows_per_file=100)
        df = frame(spark, (DAYS[0], 600), (DAYS[1], 40), (DAYS[2], 101)).repartition(13).persist()
        sink.append_new(df, 4, "q", unique=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    found = {day: files(spark, f"{sink.path}/window_date={day}/query_id=q/batch_id=4") for day in DAYS}
    assert {day: len(f) for day, f in found.items()} == {DAYS[0]: 6, DAYS[1]: 1, DAYS[2]: 2}
    sizes, ranges = [], []
    for f in found[DAYS[0]]:
        part = spark.read.parquet(f"{sink.path}/window_date={DAYS[0]}/query_id=q/batch_id=4/{f}").collect()
        keys = [(r.from_currency, r.window_start) for r in part]
        assert keys == sorted(keys)
        sizes.append(len(keys))
        ranges.append((keys[0], keys[-1]))
    assert max(sizes) < 200 and all(a[1] < b[0] for a, b in itertools.pairwise(sorted(ranges)))
    assert values(sink.read(spark)) == values(df)
    df.unpersist()


def test_one_hot_time_is_cut_by_symbol(spark):
    rows = [("2024-11-19 00:00:00", "2024-11-19 00:05:00", f"C{i}", "EUR", 1.0, 1.0, 1.0) for i in range(1000)]
    sink = KeyedTable(shared_path(spark, "test-files"), by_batch=True, rows_per_file=250)
    sink.append_new(hla_rows(spark, rows).persist(), 0, "q", unique=True)
    assert len(files(spark, f"{sink.path}/window_date=2024-11-19/query_id=q/batch_id=0")) == 4


# -- conflicts -----------------------------------------------------------------
ROW = ("2024-11-19 08:20:00", "2024-11-19 08:25:00", "BTC", "EUR", 3.0, 1.0, 2.0)


def version(high, symbol="BTC"):
    return (*ROW[:2], symbol, "EUR", high, *ROW[5:])


@pytest.mark.parametrize("by_batch", [False, True])
def test_equal_rows_once_and_differing_rows_aside(spark, by_batch):
    root = shared_path(spark, "test-conflicts")
    sink = KeyedTable(f"{root}/t", by_batch=by_batch, conflicts=QuarantineTable(f"{root}/c"))
    batch = hla_rows(spark, [version(3.0), version(3.0), version(1.0, "ETH"), version(2.0, "ETH"), version(2.0, "ETH"), version(None, "ETH"), version(5.0, "SOL")])
    for _ in range(2):  # a replay changes nothing
        sink.append_new(batch, 0, "q1")
    stored = {(r.from_currency, r.high_rate) for r in sink.read(spark).collect()}
    assert stored == {("BTC", 3.0), ("SOL", 5.0)}
    sink.append_new(hla_rows(spark, [version(3.0), version(6.0, "SOL"), version(7.0, "SOL"), version(5.0, "SOL"), version(9.0, "XRP")]), 0, "q2")
    assert {(r.from_currency, r.high_rate) for r in sink.read(spark).collect()} == stored | {("XRP", 9.0)}
    aside = sorted((r.query_id, r.from_currency, r.high_rate or 0.0, r.reason) for r in sink.conflicts.read(spark).collect())
    within = "differs within the batch"
    assert aside == [("q1", "ETH", 0.0, within), ("q1", "ETH", 1.0, within), ("q1", "ETH", 2.0, within), ("q2", "SOL", 6.0, within), ("q2", "SOL", 7.0, within)]
    sink.append_new(hla_rows(spark, [version(4.0)]), 1, "q2")
    assert [(r.high_rate, r.reason, r.batch_id) for r in sink.conflicts.read(spark).where("from_currency = 'BTC'").collect()] == [
        (4.0, "differs from the stored row", 1)]


@pytest.mark.parametrize("by_batch", [False, True])
def test_without_a_table_for_conflicts_the_write_is_refused(spark, by_batch):
    sink = KeyedTable(shared_path(spark, "test-conflicts"), by_batch=by_batch)
    with pytest.raises(ValueError, match="BTC"):
        sink.append_new(hla_rows(spark, [version(1.0), version(2.0)]), 0, "q")
    assert not sink.exists(spark)
    sink.append_new(hla_rows(spark, [version(1.0), version(1.0)]), 0, "q")
    assert sink.read(spark).count() == 1


# -- compaction ----------------------------------------------------------------
def streamed(spark, batches=5):
    sink = KeyedTable(shared_path(spark, "test-compact"), by_batch=True)
    rows = rows_of_day(DAYS[0], 60) + rows_of_day(DAYS[1], 30)
    random.Random(1).shuffle(rows)
    for b in range(batches):
        sink.append_new(hla_rows(spark, rows[b::batches]), b, "q", unique=True)
    return sink, rows, values(hla_rows(spark, rows))


def live_files(spark, sink):
    return len(sink._scan(spark).inputFiles())


def test_compacted_dates_hold_the_same_rows_in_few_files(spark):
    sink, rows, want = streamed(spark)
    assert live_files(spark, sink) == 10
    assert sink.compact(spark, DAYS[0], DAYS[0]) == [dt.date.fromisoformat(DAYS[0])]
    assert values(sink.read(spark)) == want and live_files(spark, sink) == 6
    assert sink.compact(spark, DAYS[0], DAYS[0]) == []  # nothing to merge
    assert sink.compact(spark, DAYS[0], DAYS[1]) == [dt.date.fromisoformat(DAYS[1])]
    assert values(sink.read(spark)) == want and live_files(spark, sink) == 2
    assert values(sink.read_range(spark, DAYS[0], f"{DAYS[0]} 23:59:59")) == [r for r in want if r[0].date().isoformat() == DAYS[0]]
    assert sink.vacuum(spark) == 10 and values(sink.read(spark)) == want
    # a stream replays its last batch, and goes on
    sink.append_new(hla_rows(spark, rows[4::5]), 4, "q", unique=True)
    assert values(sink.read(spark)) == want
    more = hla_rows(spark, [(*r[:2], "XRP", *r[3:]) for r in rows_of_day(DAYS[0], 9, ("XRP",))])
    sink.append_new(more, 5, "q", unique=True)
    want = sorted(want + values(more))
    assert values(sink.read(spark)) == want
    assert sink.compact(spark, DAYS[0], DAYS[1]) == [dt.date.fromisoformat(DAYS[0])]
    assert values(sink.read(spark)) == want and sink.vacuum(spark) > 0 and values(sink.read(spark)) == want
    # a backfill replaces a compacted date whole
    sink.backfill(frame(spark, (DAYS[0], 3)))
    assert values(sink.read(spark)) == sorted(values(frame(spark, (DAYS[0], 3))) + [r for r in want if r[0].date().isoformat() == DAYS[1]])


def test_crash_between_write_and_commit_changes_nothing(spark, monkeypatch):
    sink, rows, want = streamed(spark)

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", crash)
        with pytest.raises(RuntimeError, match="lost"):
            sink.compact(spark, DAYS[0], DAYS[1])
    assert values(sink.read(spark)) == want and live_files(spark, sink) == 10
    assert list_folders(spark, f"{sink.path}/{manifest.COMPACTED}")  # written, but named by no manifest
    assert len(sink.compact(spark, DAYS[0], DAYS[1])) == 2 and values(sink.read(spark)) == want
    assert sink.vacuum(spark) == 12 and values(sink.read(spark)) == want  # 10 replaced, 2 without a commit


def test_two_compactions_at_once(spark, monkeypatch):
    """The one that comes second finds its date taken and leaves it."""
    sink, rows, want = streamed(spark)
    commit, others = manifest.commit, []

    def late(*args):
        if not others:
            others.append(None)
            others[0] = KeyedTable(sink.path, by_batch=True).compact(spark, DAYS[0], DAYS[0])
        return commit(*args)

    monkeypatch.setattr(manifest, "commit", late)
    assert sink.compact(spark, DAYS[0], DAYS[1]) == [dt.date.fromisoformat(DAYS[1])]
    assert others == [[dt.date.fromisoformat(DAYS[0])]]
    assert values(sink.read(spark)) == want
    sink.vacuum(spark)
    assert values(sink.read(spark)) == want and live_files(spark, sink) == 2


def test_a_batch_that_comes_during_a_compaction_counts(spark, monkeypatch):
    sink, rows, want = streamed(spark)
    more = hla_rows(spark, [(*r[:2], "XRP", *r[3:]) for r in rows_of_day(DAYS[0], 9, ("XRP",))])
    commit = manifest.commit

    def late(*args):
        KeyedTable(sink.path, by_batch=True).append_new(more, 5, "q", unique=True)
        return commit(*args)

    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", late)
        sink.compact(spark, DAYS[0], DAYS[1])
    assert values(sink.read(spark)) == sorted(want + values(more))

import os

import pytest
from pyspark.sql import functions as F

from ticksmith.schema import SINK_HLA, SINK_PRICE
from ticksmith.session import shared_path
from ticksmith.sinks.contract import assert_unique, conform, duplicate_keys
from ticksmith.sinks.keyed import KeyedTable, QuarantineTable
from ticksmith.sources.tsv import load_copy_text, write_copy_text

from conftest import ts

HLA_COLS = "window_start timestamp_ntz, window_end timestamp_ntz, from_currency string, to_currency string, high_rate double, low_rate double, avg_rate double"


def hla_rows(spark, rows):
    return spark.createDataFrame(
        [(ts(a), ts(b) if b else None, c, d, e, f, g) for a, b, c, d, e, f, g in rows], HLA_COLS
    )


def test_conform_splits_violations(spark):
    df = hla_rows(
        spark,
        [
            ("2024-11-19 08:20:00", "2024-11-19 08:25:00", "BTC", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-19 08:20:00", "2024-11-19 08:25:00", "AVERYLONGSYMBOL", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-19 08:20:00", None, "ETH", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-19 08:20:00", "2024-11-19 08:25:00", "SOL", "EUR", 3.0, 1.0, None),
        ],
    )
    ok, bad = conform(df, SINK_HLA)
    assert [r.from_currency for r in ok.collect()] == ["BTC"]
    assert sorted(r.reason for r in bad.collect()) == [
        "avg_rate is null", "from_currency longer than 10", "window_end is null"
    ]


def test_conform_price_table_allows_null_end(spark):
    df = spark.createDataFrame(
        [(ts("2024-11-19 09:07:00"), None, "CCC", "EUR", 12.5)],
        "window_start timestamp_ntz, window_end timestamp_ntz, from_currency string, to_currency string, rate double",
    )
    ok, bad = conform(df, SINK_PRICE)
    assert ok.count() == 1 and bad.count() == 0


def test_conform_missing_column_is_plan_error(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        conform(df, SINK_HLA)


def test_duplicate_keys(spark):
    row = ("2024-11-19 08:20:00", "2024-11-19 08:25:00", "BTC", "EUR", 3.0, 1.0, 2.0)
    df = hla_rows(spark, [row, row])
    assert duplicate_keys(df).count() == 1
    with pytest.raises(ValueError):
        assert_unique(df)
    assert_unique(hla_rows(spark, [row]))


def test_keyed_table_read_range_prunes_dates(spark):
    df = hla_rows(
        spark,
        [
            ("2024-11-18 23:50:00", "2024-11-19 00:00:00", "BTC", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-19 00:00:00", "2024-11-19 00:05:00", "BTC", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-20 10:00:00", "2024-11-20 10:05:00", "BTC", "EUR", 3.0, 1.0, 2.0),
        ],
    )
    sink = KeyedTable(shared_path(spark, "test-range"))
    sink.backfill(df)
    sink.backfill(df)  # dynamic overwrite: same dates replaced, not duplicated
    assert sink.read(spark).count() == 3
    sel = sink.read_range(spark, "2024-11-19 00:00:00", "2024-11-19 23:59:59")
    assert [r.window_start for r in sel.collect()] == [ts("2024-11-19 00:00:00")]
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan


def test_quarantine_replay_overwrites_its_batch(spark):
    q = QuarantineTable(shared_path(spark, "test-quarantine"))
    bad = spark.createDataFrame([("r", "x")], "reason string, raw string")
    q.append(bad, 3)
    q.append(bad, 3)
    q.append(bad, 4)
    assert q.read(spark).count() == 2


def test_copy_text_roundtrip_with_nulls_and_terminator(spark, tmp_dir):
    text = (
        "2024-11-19 08:20:00\t2024-11-19 08:30:00\tAAA\tEUR\t4.5\t4.25\t4.375\n"
        "2024-11-19 08:20:00\t\\N\tETH\tEUR\t80.0\t70.0\t75.0\n"
        "\\.\n"
    )
    with open(os.path.join(tmp_dir, "rate_10min.tsv"), "w") as fh:
        fh.write(text)
    good, bad = load_copy_text(spark, tmp_dir, SINK_HLA)
    rows = good.collect()
    assert len(rows) == 1 and rows[0].high_rate == 4.5
    assert rows[0].window_start == ts("2024-11-19 08:20:00")
    assert sorted(r.reason for r in bad.collect()) == ["window_end is null or malformed", "window_start is null or malformed"]


def test_copy_text_write_then_load(spark, tmp_dir):
    df = hla_rows(spark, [("2024-11-19 08:20:00", "2024-11-19 08:25:00", "BTC", "EUR", 120.25, 118.125, 119.0625)])
    path = os.path.join(tmp_dir, "out")
    write_copy_text(df, path)
    good, bad = load_copy_text(spark, path, SINK_HLA)
    assert good.exceptAll(df).count() == 0 and bad.count() == 0


def test_streamed_table_is_idempotent_by_batch_id(spark):
    df = hla_rows(
        spark,
        [
            ("2024-11-18 23:50:00", "2024-11-18 23:55:00", "BTC", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-19 00:00:00", "2024-11-19 00:05:00", "BTC", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-19 00:05:00", "2024-11-19 00:10:00", "ETH", "EUR", 3.0, 1.0, 2.0),
        ],
    )
    sink = KeyedTable(shared_path(spark, "test-by-batch"), by_batch=True)
    sink.append_new(df.limit(1), 7)  # a half-finished first attempt of batch 7
    sink.append_new(df, 7)  # the replay replaces batch 7's partitions
    sink.append_new(df, 7)
    sink.append_new(df.where("from_currency = 'ETH'").withColumn("window_start", F.lit("2024-11-20 00:00:00").cast("timestamp_ntz")), 8)
    out = sink.read(spark)
    assert out.columns == df.columns
    assert out.count() == 4
    assert out.groupBy("window_start", "from_currency", "to_currency").count().where("count > 1").count() == 0
    with pytest.raises(ValueError):
        sink.append_new(df, None)


def test_read_range_lists_only_requested_dates(spark):
    sink = KeyedTable(shared_path(spark, "test-glob"), by_batch=True)
    df = hla_rows(
        spark,
        [
            ("2024-11-18 23:50:00", "2024-11-18 23:55:00", "BTC", "EUR", 3.0, 1.0, 2.0),
            ("2024-11-19 00:00:00", "2024-11-19 00:05:00", "BTC", "EUR", 3.0, 1.0, 2.0),
        ],
    )
    sink.write_batch(df, 0)
    got = sink.read_range(spark, "2024-11-19 00:00:00", "2024-11-21 00:00:00")
    assert [r.window_start for r in got.collect()] == [ts("2024-11-19 00:00:00")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "window_date=2024-11-18" not in plan
    # no stored date in range: an empty result, not an error
    assert sink.read_range(spark, "2025-07-01 00:00:00", "2025-07-02 00:00:00").count() == 0


def test_empty_quarantine_reads_empty(spark):
    q = QuarantineTable(shared_path(spark, "test-empty-quarantine"))
    q.append(spark.createDataFrame([], "reason string, raw string"), 0)
    assert q.read(spark).count() == 0
    assert QuarantineTable(shared_path(spark, "never-written")).read(spark).count() == 0


def test_publish_days_into_serving_table(spark):
    from ticksmith.sinks.keyed import publish_days

    streamed = KeyedTable(shared_path(spark, "test-pub-src"), by_batch=True)
    rows = [
        ("2024-11-19 00:00:00", "2024-11-19 00:05:00", "BTC", "EUR", 3.0, 1.0, 2.0),
        ("2024-11-19 00:05:00", "2024-11-19 00:10:00", "BTC", "EUR", 4.0, 1.0, 2.5),
        ("2024-11-20 00:00:00", "2024-11-20 00:05:00", "BTC", "EUR", 5.0, 1.0, 3.0),
    ]
    for i, r in enumerate(rows):  # one micro-batch per row
        streamed.write_batch(hla_rows(spark, [r]), i)
    serving = KeyedTable(shared_path(spark, "test-pub-dst"))
    publish_days(spark, streamed, serving, "2024-11-19", "2024-11-19")
    publish_days(spark, streamed, serving, "2024-11-19", "2024-11-19")  # re-run: same result
    out = serving.read(spark)
    assert out.count() == 2 and out.columns == hla_rows(spark, rows[:1]).columns
    with pytest.raises(ValueError):
        publish_days(spark, streamed, streamed, "2024-11-19", "2024-11-19")


DUMP = """--
-- a dump with two tables
--

CREATE TABLE public.rate_10min (window_start timestamp without time zone NOT NULL);

COPY public.rate_10min (window_start, window_end, from_currency, to_currency, high_rate, low_rate, avg_rate) FROM stdin;
2024-11-19 08:20:00\t2024-11-19 08:30:00\tAAA\tEUR\t4.5\t4.25\t4.375
2024-11-19 08:20:00\t2024-11-19 08:30:00\tETH\tEUR\t80.0\t70.0\t75.0
\\.

COPY public.rate_1min (window_start, window_end, from_currency, to_currency, rate) FROM stdin;
2024-11-19 09:07:00\t2024-11-19 09:08:00\tCCC\tEUR\t12.5
2024-11-19 09:08:00\t\\N\tCCC\tEUR\t12.75
2024-11-19 09:09:00\tbad-time\tCCC\tEUR\t13.0
\\.
"""


def test_copy_blocks_from_a_dump(spark, tmp_dir):
    from ticksmith.sources.tsv import read_copy_block

    path = os.path.join(tmp_dir, "dump.sql")
    with open(path, "w") as fh:
        fh.write(DUMP)
    t10 = read_copy_block(spark, path, "rate_10min", SINK_HLA)
    assert sorted(r.from_currency for r in t10.where("_reason IS NULL").collect()) == ["AAA", "ETH"]
    t1 = read_copy_block(spark, path, "rate_1min", SINK_PRICE).collect()
    assert len(t1) == 3
    ok = [r for r in t1 if r._reason is None]
    # window_end is nullable in the 1-minute table (\N), but text that is no timestamp is rejected
    assert [(r.rate, r.window_end) for r in ok] == [(12.5, ts("2024-11-19 09:08:00")), (12.75, None)]
    assert [r._reason for r in t1 if r._reason] == ["window_end malformed"]
    with pytest.raises(ValueError):
        read_copy_block(spark, path, "rate_5min", SINK_HLA)


def test_copy_text_rejects_malformed_nullable_value(spark, tmp_dir):
    text = (
        "2024-11-19 09:07:00\t2024-11-19 09:08:00\tCCC\tEUR\t12.5\n"
        "2024-11-19 09:08:00\t\\N\tCCC\tEUR\t12.75\n"
        "2024-11-19 09:09:00\tbad-time\tCCC\tEUR\t13.0\n"
    )
    with open(os.path.join(tmp_dir, "rate_1min.tsv"), "w") as fh:
        fh.write(text)
    good, bad = load_copy_text(spark, tmp_dir, SINK_PRICE)
    assert sorted(r.rate for r in good.collect()) == [12.5, 12.75]
    assert [r.reason for r in bad.collect()] == ["malformed row"]


def test_a_second_query_neither_removes_nor_repeats_stored_keys(spark):
    first = ("2025-08-03 10:00:00", "2025-08-03 10:05:00", "AAA", "EUR", 3.0, 1.0, 2.0)
    other = ("2025-08-03 10:05:00", "2025-08-03 10:10:00", "BBB", "EUR", 9.0, 7.0, 8.0)
    sink = KeyedTable(shared_path(spark, "test-two-queries"), by_batch=True)
    sink.append_new(hla_rows(spark, [first, first]), 0, "one")
    sink.append_new(hla_rows(spark, [first, other]), 0, "two")  # batch numbers start again
    sink.append_new(hla_rows(spark, [first, other]), 0, "two")  # and its replay
    assert sorted(r.from_currency for r in sink.read(spark).collect()) == ["AAA", "BBB"]


def test_backfill_into_a_streamed_table(spark):
    rows = [(f"2025-08-0{d} 10:00:00", f"2025-08-0{d} 10:05:00", "AAA", "EUR", 3.0, 1.0, 2.0) for d in (3, 4, 5)]
    sink = KeyedTable(shared_path(spark, "test-one-layout"), by_batch=True)
    sink.append_new(hla_rows(spark, rows), 0, "one")
    new = ("2025-08-03 11:00:00", "2025-08-03 11:05:00", "AAA", "EUR", 5.0, 1.0, 2.0)
    for _ in range(2):  # the date of the new rows is replaced, the one without rows goes
        sink.backfill(hla_rows(spark, [new]), first_day="2025-08-03", last_day="2025-08-04")
    sink.append_new(hla_rows(spark, [new, rows[0]]), 1, "one")  # the stream goes on: a stored key is skipped
    got = sorted(str(r.window_start) for r in KeyedTable(sink.path, by_batch=True).read(spark).collect())
    assert got == ["2025-08-03 10:00:00", "2025-08-03 11:00:00", "2025-08-05 10:00:00"]


def test_stream_of_a_table_of_part_files(spark, tmp_dir):
    from ticksmith.sources.events import events_as_ticks, read_ticks, stream_table

    events = spark.createDataFrame(
        [(i, ts(f"2025-08-03 10:0{i}:00"), "AAA", float(i)) for i in range(8)], "event_id long, ts timestamp_ntz, event_type string, value double")
    events.repartition(4).write.parquet(f"{tmp_dir}/parts/events.parquet")
    events.coalesce(1).write.parquet(f"{tmp_dir}/one")
    os.makedirs(f"{tmp_dir}/file")
    part = next(f for f in os.listdir(f"{tmp_dir}/one") if f.endswith(".parquet"))
    os.rename(f"{tmp_dir}/one/{part}", f"{tmp_dir}/file/events.parquet")
    for form, files in (("parts", 1), ("file", None)):
        q = events_as_ticks(stream_table(spark, f"{tmp_dir}/{form}", "events", max_files_per_trigger=files))
        out = f"{tmp_dir}/out-{form}"
        q.writeStream.option("checkpointLocation", f"{out}-c").trigger(availableNow=True).format("parquet").start(out).awaitTermination()
        assert spark.read.parquet(out).count() == read_ticks(spark, f"{tmp_dir}/{form}").count() == 8
    with pytest.raises(Exception):
        stream_table(spark, f"{tmp_dir}/none", "events")

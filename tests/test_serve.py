import datetime as dt

from ticksmith.plans import serve
from ticksmith.operators.filters import symbols_in, symbols_in_table

from conftest import ts

COLS = "window_start timestamp_ntz, window_end timestamp_ntz, from_currency string, to_currency string, high_rate double, low_rate double, avg_rate double"


def table(spark):
    rows = []
    for i, coin in enumerate(("DOGE", "BTC")):
        for m in range(0, 60, 5):
            s = dt.datetime(2025, 6, 19, 18, m)
            rows.append((s, s + dt.timedelta(minutes=5), coin, "EUR", 3.0 + i, 1.0 + i, 2.0 + i))
    return spark.createDataFrame(rows, COLS)


def test_panels_filter_alias_and_order(spark):
    t = table(spark)
    start, end = serve.last("15 minutes", now=dt.datetime(2025, 6, 19, 18, 30))
    hl = serve.high_low_series(t, "DOGE", start, end)
    assert hl.columns == ["currency", "high", "low", "time"]
    assert [r.time.minute for r in hl.collect()] == [15, 20, 25, 30]  # closed range, time order
    mam = serve.min_avg_max_series(t, "BTC", start, end).collect()
    assert mam[0].asDict() == {"currency": "BTC", "minimum": 2.0, "average": 3.0, "maximum": 4.0, "time": ts("2025-06-19 18:15:00")}


def test_price_series_and_coin_list(spark):
    t = table(spark).selectExpr("window_start", "window_end", "from_currency", "to_currency", "avg_rate AS rate")
    ps = serve.price_series(t, "BTC", "2025-06-19 18:00:00", "2025-06-19 18:05:00")
    assert ps.columns == ["currency", "rate", "time"] and ps.count() == 2
    assert [r.from_currency for r in serve.coin_list(t).collect()] == ["BTC", "DOGE"]


def test_panel_predicates_reach_the_scan(spark, tmp_dir):
    table(spark).write.parquet(f"{tmp_dir}/t")
    t = spark.read.parquet(f"{tmp_dir}/t")
    plan = serve.high_low_series(t, "DOGE", "2025-06-19 18:00:00", "2025-06-19 18:20:00")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(from_currency,DOGE)" in plan and "GreaterThanOrEqual(window_start" in plan


def test_windowed_for_range_scans_only_needed_ticks(spark):
    from ticksmith.config import HLA
    from ticksmith.sources.events import read_ticks
    from conftest import SMOKE_DIR

    df = serve.windowed_for_range(
        lambda since, until: read_ticks(spark, SMOKE_DIR, since=since, until=until),
        "1 hour", HLA, "2024-01-10 00:30:00", "2024-01-10 05:00:00", coin="view",
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan and "LessThan(ts,2024-01-10T06:00)" in plan
    starts = [r.window_start for r in df.collect()]
    assert starts and min(starts) >= ts("2024-01-10 01:00:00") and max(starts) <= ts("2024-01-10 05:00:00")


def test_symbol_membership(spark):
    df = spark.createDataFrame([("BTC",), ("XYZ",), ("DOGE",)], "from string")
    assert sorted(r["from"] for r in symbols_in(df, ["BTC", "DOGE"]).collect()) == ["BTC", "DOGE"]
    syms = spark.createDataFrame([("BTC",)], "symbol string")
    assert [r["from"] for r in symbols_in_table(df, syms).collect()] == ["BTC"]


def test_sql_panel_prunes_stored_table_partitions(spark):
    from ticksmith.plans.panel_sql import run_panel
    from ticksmith.session import shared_path
    from ticksmith.sinks.keyed import KeyedTable

    sink = KeyedTable(shared_path(spark, "test-sql-prune"))
    sink.backfill(table(spark))
    spark.read.parquet(sink.path).createOrReplaceTempView("stored_t5")
    df = run_panel(spark, "high_low", "stored_t5", "DOGE", "2025-06-19 18:00:00", "2025-06-19 18:20:00")
    assert [r.time.minute for r in df.collect()] == [0, 5, 10, 15, 20]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan


def test_symbol_table_broadcast_only_within_bound(spark):
    df = spark.createDataFrame([("BTC", 1.0), ("XYZ", 2.0), ("DOGE", 3.0)], "from string, rate double")
    syms = spark.createDataFrame([("BTC",), ("DOGE",), ("BTC",)], "symbol string")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for bound, join in (("10m", "BroadcastHashJoin"), ("1b", "SortMergeJoin"), ("-1", "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            found = symbols_in_table(df, syms)
            assert sorted(r["from"] for r in found.collect()) == ["BTC", "DOGE"]
            assert join in found._jdf.queryExecution().executedPlan().toString(), bound
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)

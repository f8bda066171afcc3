import pytest
from pyspark.sql import functions as F

from ticksmith.config import DEFAULT_JOBS, HLA, PRICE, WindowSpec
from ticksmith.operators.rollup import finest_width, partials, rollup
from ticksmith.operators.tumbling import tumbling
from ticksmith.plans.backfill import backfill_tables
from ticksmith.session import shared_path
from ticksmith.sources.events import read_ticks

from conftest import ORACLE_DIR, SMOKE_DIR


def test_finest_width():
    assert finest_width(["1 minute", "5 minutes", "10 minutes"]) == "60 seconds"
    assert finest_width(["10 minutes", "1 hour"]) == "600 seconds"


@pytest.mark.parametrize("width", ["5 minutes", "10 minutes", "1 hour", "1 day"])
def test_rollup_equals_direct_aggregate(spark, width):
    ticks = read_ticks(spark, ORACLE_DIR)
    parts = partials(ticks, "1 minute").persist()
    got = rollup(parts, width, HLA).alias("g")
    want = tumbling(ticks, width, HLA).alias("w")
    keys = ["window_start", "window_end", "from_currency", "to_currency"]
    j = got.join(want, keys, "full_outer")
    assert j.count() == want.count() == got.count()
    bad = j.where(
        F.col("g.high_rate").isNull() | F.col("w.high_rate").isNull()
        | (F.col("g.high_rate") != F.col("w.high_rate"))
        | (F.col("g.low_rate") != F.col("w.low_rate"))
        | (F.abs(F.col("g.avg_rate") - F.col("w.avg_rate")) > 1e-9 * F.abs(F.col("w.avg_rate")) + 1e-12)
    ).count()
    assert bad == 0
    parts.unpersist()


def test_backfill_tables_one_scan(spark):
    root = shared_path(spark, "test-backfill")
    sinks = backfill_tables(read_ticks(spark, SMOKE_DIR), DEFAULT_JOBS, root)
    direct = {s.name: tumbling(read_ticks(spark, SMOKE_DIR), s.width, s.aggs) for s in DEFAULT_JOBS}
    for name, sink in sinks.items():
        assert sink.read(spark).count() == direct[name].count()
    assert sinks["1min"].read(spark).columns == ["window_start", "window_end", "from_currency", "to_currency", "rate"]


def test_backfill_cli(spark):
    from ticksmith.plans.backfill import main

    root = shared_path(spark, "test-backfill-cli")
    # a range cut inside days is widened to whole days (dates are replaced whole)
    assert main(["--path", SMOKE_DIR, "--tables", root, "--since", "2024-01-10 06:00", "--until", "2024-01-11 18:00"]) == 0
    t10 = spark.read.parquet(f"{root}/rate_10min")
    days = {r.window_date.isoformat() for r in t10.select("window_date").distinct().collect()}
    assert days == {"2024-01-10", "2024-01-11"}
    full = tumbling(read_ticks(spark, SMOKE_DIR, since="2024-01-10", until="2024-01-12"), "10 minutes", HLA)
    assert t10.count() == full.count()

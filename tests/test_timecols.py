import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticksmith.functions import timecols as TC

from conftest import ts


@pytest.mark.parametrize(
    "text, secs",
    [("1 minute", 60), ("5 minutes", 300), ("10 minutes", 600), ("1 hour", 3600), ("14 days", 14 * 86400),
     ("60 seconds", 60), ("1 week", 7 * 86400)],
)
def test_interval_seconds(text, secs):
    assert TC.interval_seconds(text) == secs


def test_interval_rejects_unknown_units():
    with pytest.raises(ValueError):
        TC.interval_seconds("3 fortnights")
    with pytest.raises(ValueError):
        TC.interval_seconds("soon")


def test_bucket_start_and_ranges(spark):
    df = spark.createDataFrame([(ts("2025-06-19 18:07:59"),)], "t timestamp")
    assert df.select(TC.bucket_start("t", "5 minutes").alias("b")).first().b == ts("2025-06-19 18:05:00")
    start, end = TC.relative_range(dt.datetime(2025, 6, 19, 18, 0), "3 hours")
    assert (start, end) == (dt.datetime(2025, 6, 19, 15, 0), dt.datetime(2025, 6, 19, 18, 0))
    s_col, e_col = TC.relative_range_col("3 hours")
    r = spark.range(1).select((e_col - s_col).alias("d")).first()
    assert r.d == dt.timedelta(hours=3)
    assert spark.range(1).select(TC.as_ntz("2025-06-19 18:00:00").alias("x")).first().x == ts("2025-06-19 18:00:00")

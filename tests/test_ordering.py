import random

import pytest

from conftest import SMOKE_DIR

from ticksmith.operators.ordering import positioned
from ticksmith.plans import registry
from ticksmith.session import list_names
from ticksmith.streaming.progress import read_progress, totals


def test_positions_over_many_tasks(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "é", ""]), rng.randint(0, 10**6), i) for i in range(5000)]
    got = positioned(spark.createDataFrame(rows, "k string, n long, i long").repartition(6), ["k", "n", "i"]).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(5000))


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], "k string")
    assert positioned(df, ["k"]).count() == 0
    with pytest.raises(ValueError):
        positioned(df, ["k"], name="k")


def test_registered_streams_run_in_several_batches(spark):
    path = registry.run_stream_job(spark, SMOKE_DIR, "1 minute", registry.PRICE, "batches")
    progress = read_progress(spark, path.replace("/table", "/checkpoint/progress"))
    found = totals(progress).first()
    assert found.data_batches == registry.STREAM_BATCHES and found.input_rows == spark.read.parquet(f"{SMOKE_DIR}/events.parquet").count()
    assert found.dropped_rows == 0
    landed = path.replace("/table", "/landed")
    spans = [spark.read.parquet(f"{landed}/{n}").selectExpr("min(timestamp)", "max(timestamp)").first()
             for n in sorted(list_names(spark, landed)) if n.endswith(".parquet")]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))

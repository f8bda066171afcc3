import json

import pytest
from pyspark.sql import functions as F

from ticksmith.functions import ticks_json as TJ
from ticksmith.operators.quality import reason_counts, split

from conftest import ts

GOOD = '{"from":"BTC","to":"EUR","timestamp":"2023-03-08T09:17:42.000Z","rate":41235.75}'


def tagged(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return {r._raw: r for r in TJ.tag_ticks(df).collect()}


def test_good_message(spark):
    r = tagged(spark, [GOOD])[GOOD]
    assert (r["from"], r["to"], r["rate"], r["_reason"]) == ("BTC", "EUR", 41235.75, None)
    assert r["timestamp"] == ts("2023-03-08 09:17:42")


@pytest.mark.parametrize(
    "value, reason",
    [
        ("garbage", TJ.R_NOT_OBJECT),
        ("[]", TJ.R_NOT_OBJECT),
        ('{"from":"BTC","to":"EUR","timestamp":"nope","rate":1.0}', TJ.R_NO_TIME),
        ('{"from":"BTC","to":"EUR","rate":1.0}', TJ.R_NO_TIME),
        ('{"from":"BTC","to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":"2.5"}', TJ.R_NO_RATE),
        ('{"from":"BTC","to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":null}', TJ.R_NO_RATE),
        ('{"to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":1.0}', TJ.R_NO_SYMBOL),
    ],
)
def test_bad_messages_get_a_reason(spark, value, reason):
    assert tagged(spark, [value])[value]["_reason"] == reason


def test_null_message(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert TJ.tag_ticks(df).first()["_reason"] == TJ.R_NULL


def test_lenient_values(spark):
    vals = [
        '{"from":"A","to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":1}',
        '{"from":"B","to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":1e3}',
        '{"from":"C","to":"EUR","timestamp":"2023-03-08T11:17:42.123456+02:00","rate":1.5}',
        '{"from":"D","to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":1.5,"extra":true}',
        '{"from":"E","to":"EUR","timestamp":1678267062,"rate":2.0}',
    ]
    out = {r["from"]: r for r in tagged(spark, vals).values()}
    assert out["A"]["rate"] == 1.0 and out["B"]["rate"] == 1000.0
    assert out["C"]["timestamp"] == ts("2023-03-08 09:17:42.123456")
    assert out["D"]["_reason"] is None
    assert out["E"]["timestamp"] == ts("2023-03-08 09:17:42")  # integer = epoch seconds


def test_binary_value_and_split(spark):
    df = spark.createDataFrame([(bytearray(GOOD, "utf8"),), (bytearray(b"junk"),)], "value binary")
    good, bad = split(TJ.tag_ticks(df))
    assert good.columns == ["from", "to", "timestamp", "rate"]
    assert good.count() == 1
    assert [tuple(r) for r in reason_counts(bad).collect()] == [(TJ.R_NOT_OBJECT, 1)]


def test_tick_json_shape(spark):
    df = spark.createDataFrame(
        [("BTC", "EUR", ts("2023-03-08 09:17:42.789123"), 41235.75)],
        "from string, to string, timestamp timestamp, rate double",
    )
    text = df.select(TJ.tick_json().alias("v")).first().v
    assert text == '{"from":"BTC","to":"EUR","timestamp":"2023-03-08T09:17:42.789Z","rate":41235.75}'
    assert list(json.loads(text)) == ["from", "to", "timestamp", "rate"]


def test_parse_ticks_keeps_every_row(spark):
    df = spark.createDataFrame([(GOOD,), ("garbage",)], "value string")
    rows = TJ.parse_ticks(df).collect()
    assert len(rows) == 2 and sum(r["from"] is None for r in rows) == 1

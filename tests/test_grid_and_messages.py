import json

import pytest

from ticksmith.config import SYMBOLS
from ticksmith.sinks.messages import kafka_sink_options, message_frame
from ticksmith.sources.grid import request_grid, symbols_frame
from ticksmith.sources.kafka import kafka_options, kafka_reader

from conftest import ts


def test_request_grid(spark):
    grid = request_grid(symbols_frame(spark, SYMBOLS + ("MY COIN",)), url_template="https://q/x?symbol=%s&convert=%s")
    rows = {r.symbol: r for r in grid.collect()}
    assert len(rows) == 9
    assert rows["BTC"].key == "BTC_EUR" and rows["BTC"].url == "https://q/x?symbol=BTC&convert=EUR"
    assert rows["MY COIN"].url == "https://q/x?symbol=MY%20COIN&convert=EUR"


def test_grid_two_targets(spark):
    grid = request_grid(symbols_frame(spark, ["BTC"]), targets=["EUR", "USD"])
    assert sorted(r.key for r in grid.collect()) == ["BTC_EUR", "BTC_USD"]


def test_message_frame(spark):
    ticks = spark.createDataFrame(
        [("BTC", "EUR", ts("2023-03-08 09:17:42"), 41235.75)],
        "from string, to string, timestamp timestamp, rate double",
    )
    r = message_frame(ticks).first()
    assert r.key == "BTC_EUR"
    assert json.loads(r.value) == {"from": "BTC", "to": "EUR", "timestamp": "2023-03-08T09:17:42.000Z", "rate": 41235.75}


def test_kafka_options_and_missing_connector(spark):
    opts = kafka_options("broker:9092", "prices", max_offsets_per_trigger=1000, min_partitions=8)
    assert opts["startingOffsets"] == "latest" and opts["subscribe"] == "prices"
    assert opts["maxOffsetsPerTrigger"] == "1000" and opts["minPartitions"] == "8"
    assert kafka_sink_options("b:1", "t")["kafka.acks"] == "all"
    # The connector jar is not in this environment: loading fails cleanly.
    with pytest.raises(Exception):
        kafka_reader(spark, opts).load()

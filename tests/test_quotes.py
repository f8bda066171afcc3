import json

import pytest
from pyspark.sql import functions as F

from ticksmith.functions import quotes as Q
from ticksmith.operators.quality import split

from conftest import ts


def resp(sym="BTC", cur="EUR", price=41235.75, updated="2023-03-08T09:17:42.000Z", status=None, extra_elem=False, raw=None):
    if raw is not None:
        return raw
    doc = {"status": status if status is not None else {"error_code": 0, "error_message": None}}
    elem = {"quote": {cur: {"price": price, "last_updated": updated}}}
    arr = [elem] + ([{"quote": {cur: {"price": 1.0, "last_updated": updated}}}] if extra_elem else [])
    doc["data"] = {sym: arr}
    return json.dumps(doc)


def flatten(spark, rows):
    df = spark.createDataFrame(rows, "id int, symbol string, currency string, body string")
    return {r.id: r for r in Q.flatten_requested(df, keep=("id",)).collect()}


def test_good_response_and_first_element_only(spark):
    out = flatten(spark, [(1, "BTC", "EUR", resp()), (2, "BTC", "EUR", resp(extra_elem=True))])
    for i in (1, 2):
        r = out[i]
        assert (r["from"], r["to"], r.rate, r._reason) == ("BTC", "EUR", 41235.75, None)
        assert r.timestamp == ts("2023-03-08 09:17:42")
        assert r.timestamp_text == "2023-03-08T09:17:42.000Z"


@pytest.mark.parametrize(
    "body, sym, cur, reason",
    [
        (json.dumps({"status": {"error_code": 1001, "error_message": "bad key"}}), "BTC", "EUR", "API error: bad key"),
        (json.dumps({"status": {"error_code": 1002}}), "BTC", "EUR", "API error: "),
        (json.dumps({"data": {}}), "BTC", "EUR", Q.R_FORMAT),
        (resp(sym="ETH"), "BTC", "EUR", "data.BTC not found"),
        (resp(cur="USD"), "BTC", "EUR", "quote.EUR not found"),
        (json.dumps({"status": {"error_code": 0}, "data": {"BTC": []}}), "BTC", "EUR", "data.BTC is empty"),
        (resp(price=None), "BTC", "EUR", Q.R_NO_PRICE),
        (resp(price="abc"), "BTC", "EUR", Q.R_NO_PRICE),
        (resp(updated=None), "BTC", "EUR", Q.R_NO_UPDATED),
        (resp(updated="yesterday"), "BTC", "EUR", Q.R_BAD_UPDATED),
        ("this is not json", "BTC", "EUR", Q.R_FORMAT),
        (None, "BTC", "EUR", Q.R_EMPTY),
        (resp(), None, "EUR", Q.R_NO_REQUEST),
        (resp(), "BTC", None, Q.R_NO_REQUEST),
    ],
)
def test_rejections(spark, body, sym, cur, reason):
    assert flatten(spark, [(1, sym, cur, body)])[1]._reason == reason


def test_one_bad_symbol_does_not_stop_others(spark):
    rows = [(1, "BTC", "EUR", resp()), (2, "ETH", "EUR", "junk"), (3, "DOGE", "EUR", resp(sym="DOGE", price=0.15))]
    df = spark.createDataFrame(rows, "id int, symbol string, currency string, body string")
    good, bad = split(Q.flatten_requested(df))
    assert sorted(r["from"] for r in good.collect()) == ["BTC", "DOGE"]
    assert [r.reason for r in bad.collect()] == [Q.R_FORMAT]


def test_flatten_all_without_request(spark):
    doc = {
        "status": {"error_code": 0},
        "data": {
            "BTC": [{"quote": {"EUR": {"price": 1.0, "last_updated": "2023-03-08T12:00:00Z"},
                               "USD": {"price": 2.0, "last_updated": "2023-03-08T12:00:00Z"}}}],
            "ETH": [],
        },
    }
    err = {"status": {"error_code": 1001, "error_message": "x"}}
    df = spark.createDataFrame([(json.dumps(doc),), (json.dumps(err),)], "body string")
    rows = Q.flatten_all(df).collect()
    good = sorted((r["from"], r["to"], r.rate) for r in rows if r._reason is None)
    assert good == [("BTC", "EUR", 1.0), ("BTC", "USD", 2.0)]
    reasons = sorted(r._reason for r in rows if r._reason is not None)
    assert reasons == ["API error: x", "data.ETH is empty"]


def test_landed_roundtrip(spark, tmp_dir):
    from ticksmith.sources.responses import read_landed

    for name, body in (("BTC_EUR-1.json", resp()), ("ETH_EUR-1.json", resp(sym="ETH", price=2000.5))):
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.write(body)
    with open(f"{tmp_dir}/unnamed.json", "w") as fh:
        fh.write(resp())
    landed = read_landed(spark, tmp_dir)
    good, bad = split(Q.flatten_requested(landed))
    assert sorted((r["from"], r.rate) for r in good.collect()) == [("BTC", 41235.75), ("ETH", 2000.5)]
    assert [r.reason for r in bad.collect()] == [Q.R_NO_REQUEST]


def test_land_responses_builds_service_shape(spark):
    from ticksmith.sources.responses import land_responses

    ticks = spark.createDataFrame(
        [("BTC", "EUR", ts("2023-03-08 09:17:42"), 1.5), ("ERR", "EUR", ts("2023-03-08 09:17:42"), 2.0)],
        "from string, to string, timestamp timestamp, rate double",
    )
    rows = {r.symbol: json.loads(r.body) for r in land_responses(ticks, failed=F.col("from") == "ERR").collect()}
    assert rows["BTC"]["data"]["BTC"][0]["quote"]["EUR"] == {"price": 1.5, "last_updated": "2023-03-08T09:17:42.000Z"}
    assert rows["ERR"]["status"]["error_code"] != 0 and "data" not in rows["ERR"]

import json
import os

from pyspark.sql import functions as F

from ticksmith.functions.documents import documents, split_documents
from ticksmith.functions.ticks_json import tag_ticks
from ticksmith.sources.responses import read_landed


def test_documents_of_a_text():
    one, two = {"a": {"b": ["}", '"]', "\\"]}, "c": "{"}, [1, {"x": "\\\"}"}]
    for sep in ("", "\n", " ,\r\n\t"):
        assert [json.loads(d) for d in split_documents(sep + json.dumps(one, indent=2) + sep + json.dumps(two) + sep + json.dumps(one))] == [one, two, one]
    assert split_documents('{"a": 1}{"b": ') == ['{"a": 1}', '{"b":']
    assert split_documents('{"a": "open} {"b": 1}') == ['{"a": "open} {"b": 1}']
    assert split_documents('502 } {"a": 1} oops [2]') == ["502 }", '{"a": 1}', "oops", "[2]"]
    assert split_documents("") == [""] and split_documents(" \n") == [" \n"] and split_documents('"text"') == ['"text"']
    assert len(split_documents("{}" * 50_000)) == 50_000 and split_documents("[" * 200_000) == ["[" * 200_000]


def test_column_keeps_nulls(spark):
    got = spark.createDataFrame([(None,), ("",), ("{}{}",)], "t string").select(documents(F.col("t")).alias("d")).collect()
    assert [r.d for r in got] == [None, [""], ["{}", "{}"]]


def test_every_document_of_a_landed_file(spark, tmp_dir):
    for name, text in (("BTC_EUR.json", '{"a": 1}'), ("ETH_EUR-2.json", '{"a": 2}\n{"a": 3}'), ("odd.json", '{"a": 4}{"a":'), ("ADA_EUR.json", "")):
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(text)
    got = sorted((r.source_file, r.document, r.symbol, r.currency, r.body) for r in read_landed(spark, tmp_dir).collect())
    assert [g for g in got if g[0] != "ADA_EUR.json"] == [
        ("BTC_EUR.json", 0, "BTC", "EUR", '{"a": 1}'), ("ETH_EUR-2.json", 0, "ETH", "EUR", '{"a": 2}'), ("ETH_EUR-2.json", 1, "ETH", "EUR", '{"a": 3}'),
        ("odd.json", 0, None, None, '{"a": 4}'), ("odd.json", 1, None, None, '{"a":')]


def test_numbers_that_are_none_and_blank_names_are_set_aside(spark):
    rows = ['{"from":"A","to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":%s}' % r for r in ("NaN", "Infinity", "-Infinity", '"NaN"', "1e400", "2")]
    rows += ['{"from":"%s","to":"EUR","timestamp":"2023-03-08T09:17:42Z","rate":1}' % s for s in ("", "  ")]
    got = [r._reason for r in tag_ticks(spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1)).collect()]
    assert got == ["missing or non-numeric rate"] * 5 + [None] + ["missing from/to"] * 2

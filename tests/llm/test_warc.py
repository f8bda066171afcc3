import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ticksmith.llm import warc
from ticksmith.llm.queries import op10_warc


def brute(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        digest, same = hashlib.sha1(data).hexdigest(), groups[html or ""]
        large = len(data) >= 1000
        top = max((p for p in same if p is not None), default=None)
        revisit = large and len(same) > 1 and page != top
        out.append((page, len(data), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


PAGES = "page_id long, url string, html string"


def test_records_equal_brute_force(spark, tmp_dir):
    big, long = "é" * 500, "<p>\r\n\r\n</p>" * 60000
    rows = [(1, "http://a/", big), (2, None, big), (7, "http://b/ c%", big), (3, "u", "é" * 499 + "a"), (4, "u\r\nX: y", "é" * 499 + "a"),
            (5, "", None), (6, "x", ""), (8, "l", long), (9, "l", long), (None, "n", big), (None, "n", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash"))
    warc.write(pages, f"{tmp_dir}/w", shard_bytes=100, file_bytes=300)
    back = warc.read(spark, f"{tmp_dir}/w")
    assert got(back) == brute(rows) and all(r.intact for r in back.collect())


def test_repeated_rows_and_empty(spark, tmp_dir):
    rows = [(1, "u", "x" * 2000)] * 3
    warc.write(spark.createDataFrame(rows, PAGES), f"{tmp_dir}/w")
    assert [r[3:] for r in got(warc.read(spark, f"{tmp_dir}/w"))] == [("response", None), ("revisit", 1), ("revisit", 1)]
    warc.write(spark.createDataFrame([], PAGES), f"{tmp_dir}/e")
    assert warc.read(spark, f"{tmp_dir}/e").count() == 0


def test_same_files_whatever_the_partitions(spark, tmp_dir):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")

    def files(name, df):
        warc.write(df, f"{tmp_dir}/{name}", shard_bytes=200_000, file_bytes=20_000)
        names = sorted(f for f in os.listdir(f"{tmp_dir}/{name}") if f.startswith("shard"))
        return {f: hashlib.sha1(open(f"{tmp_dir}/{name}/{f}", "rb").read()).hexdigest() for f in names}

    one = files("a", pages)
    assert len(one) > 5 and one == files("b", pages.repartition(7, F.rand()))


def test_a_damaged_archive_is_an_error(spark, tmp_dir):
    warc.write(spark.createDataFrame([(1, "u", "x" * 2000)], PAGES), f"{tmp_dir}/w")
    with open(f"{tmp_dir}/w/shard-00000-0000.warc.gz", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="manifest"):
        warc.read(spark, f"{tmp_dir}/w").collect()


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    assert got(op10_warc(spark, sf)) == brute([tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()])

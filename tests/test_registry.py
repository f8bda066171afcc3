"""Every registered query against its DuckDB oracle at sf0.01 (the driver's scale), and the entry."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest, rows_of  # noqa: E402

from ticksmith.plans import registry  # noqa: E402
from conftest import ORACLE_DIR, SMOKE_DIR  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{ORACLE_DIR}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["window_start", "window_end", "from_currency", "to_currency"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    missing = set(registry.queries()) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    spdf = E.queries()[name](spark, ORACLE_DIR).toPandas()
    dpdf = duck.execute(E.oracle_sql()[name]).fetchdf()
    sc, sr = rows_of(spdf)
    dc, dr = rows_of(dpdf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert digest(sr) == digest(dr)

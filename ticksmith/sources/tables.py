"""Scans of stored windowed tables (the read side's data source).

Parquet tables written by :class:`ticksmith.sinks.keyed.KeyedTable` are
partitioned by ``window_date``; a time-range filter on ``window_start`` is
repeated on ``window_date`` so the scan prunes whole partitions, and the
remaining predicates are pushed to row groups.  A JDBC table gets the same
predicates pushed into its WHERE clause.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYOUT_COLS = ("window_date", "query_id", "batch_id")


def read_windowed(spark: SparkSession, path: str, keep_partition_col: bool = False) -> DataFrame:
    """All rows of a stored windowed table (layout columns dropped)."""
    df = spark.read.parquet(path)
    if not keep_partition_col:
        df = df.drop(*[c for c in LAYOUT_COLS if c in df.columns])
    return df


def read_windowed_jdbc(spark: SparkSession, url: str, table: str, **props) -> DataFrame:
    """A windowed table in a relational database (credentials come from ``props``)."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**props).load()

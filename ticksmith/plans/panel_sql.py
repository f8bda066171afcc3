"""The dashboard's panel SQL, run by Spark SQL with named parameters.

Same queries as :mod:`ticksmith.plans.serve`, for users who keep their
dashboards as SQL text.  ``:coin``, ``:start`` and ``:end`` are bound by
``spark.sql(text, args=...)`` -- values are never pasted into the SQL string.
The time macro of the original dashboard (``$__timeFilter(window_start)``)
is the closed range ``window_start BETWEEN :start AND :end`` (wall-clock
text bound as a string and cast in SQL, so the predicate still folds to a
constant and reaches the scan).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

_WHERE = (
    "WHERE window_start BETWEEN CAST(:start AS TIMESTAMP_NTZ) AND CAST(:end AS TIMESTAMP_NTZ) "
    "AND from_currency = :coin"
)

PANELS = {
    "price": f"""
        SELECT from_currency AS currency, rate AS rate, window_start AS time
        FROM {{table}} {_WHERE}
        ORDER BY from_currency, window_start""",
    "high_low": f"""
        SELECT from_currency AS currency, high_rate AS high, low_rate AS low, window_start AS time
        FROM {{table}} {_WHERE}
        ORDER BY from_currency, window_start""",
    "min_avg_max": f"""
        SELECT from_currency AS currency, low_rate AS minimum, avg_rate AS average,
               high_rate AS maximum, window_start AS time
        FROM {{table}} {_WHERE}
        ORDER BY from_currency, window_start""",
    "coins": """
        SELECT DISTINCT from_currency FROM {table} ORDER BY from_currency""",
}


def _ntz(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return dt.datetime.fromisoformat(str(v))


def run_panel(spark: SparkSession, panel: str, table: str, coin: str | None = None, start=None, end=None) -> DataFrame:
    """Run one panel against a table or temp view name."""
    sql = PANELS[panel].format(table=table)
    if panel == "coins":
        return spark.sql(sql)
    if "window_date" in spark.table(table).columns:
        # a stored, date-partitioned table: the same range prunes partitions
        sql = sql.replace(
            "AND from_currency = :coin",
            "AND from_currency = :coin "
            "AND window_date BETWEEN CAST(CAST(:start AS TIMESTAMP_NTZ) AS DATE) "
            "AND CAST(CAST(:end AS TIMESTAMP_NTZ) AS DATE)",
        )
    args = {
        "coin": coin,
        "start": _ntz(start).isoformat(sep=" "),
        "end": _ntz(end).isoformat(sep=" "),
    }
    return spark.sql(sql, args=args)

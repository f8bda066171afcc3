"""The place of each row in a sorted result, without one task that sees all rows.

``orderBy`` gives an order that a consumer cannot check and a written table does not keep.  Here rows are sorted by
range over many tasks, each task numbers its own, and the rows of the tasks before it are added: what is
brought together is one row for each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.session import staged


def positioned(df: DataFrame, keys: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with the place (from 0) of each row in the order of ``keys``, nulls first; ties come in any order.

    The sorted rows are written once to the shared folder: the numbers rest on the tasks that wrote them.
    """
    if name in df.columns:
        raise ValueError(f"a column is named like the result: {name}")
    order = [F.col(k).asc_nulls_first() for k in keys]
    rows = staged(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"_task": F.spark_partition_id(), "_line": F.monotonically_increasing_id()}), "ordered")
    tasks = rows.groupBy("_task").agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = tasks.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n") - F.col("_first")).alias("_shift"))
    return rows.join(before, "_task").select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_line") + F.col("_shift")).alias(name))

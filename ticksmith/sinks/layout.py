"""Files of a write: a set number of sorted files for each date, without adaptive execution.

Inside a stateful stream Spark plans without AQE, so a rebalance hint has no effect there and every state
partition writes a file for each date it holds.  Here each date gets as many files as its rows need, and its rows go to
them by the range of the sort key: the bounds are quantiles of a sample of the date's keys, of
SAMPLE keys for each file.  Each row's file is a partition number of its own, so no two dates or ranges share a task.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 100


def files_of(counts: Mapping, rows_per_file: int) -> dict:
    """The files of each date for its number of rows."""
    return {day: max(1, -(-n // rows_per_file)) for day, n in counts.items()}


def _bounds(df: DataFrame, day_col: str, sort_cols: Sequence[str], counts: Mapping, files: Mapping) -> dict:
    """Keys that cut each date of more than one file into parts of about the same number of rows."""
    many = {day: n for day, n in files.items() if n > 1}
    if not many:
        return {}
    share = F.lit(0.0)
    for day, n in many.items():
        share = F.when(F.col(day_col).eqNullSafe(F.lit(day)), min(1.0, SAMPLE * n / counts[day])).otherwise(share)
    # the draw hangs on the key alone: a repeated write has the same files
    drawn = df.where(F.col(day_col).isin(list(many)) & (F.pmod(F.xxhash64(*sort_cols), F.lit(1 << 30)) < share * (1 << 30)))
    keys: dict = {}
    for row in drawn.select(day_col, *sort_cols).collect():
        keys.setdefault(row[0], []).append(tuple(row)[1:])
    return {day: [sorted(ks, key=lambda k: [(v is not None, v) for v in k])[len(ks) * i // many[day]] for i in range(1, many[day])]
            for day, ks in keys.items()}


def in_files(df: DataFrame, day_col: str, sort_cols: Sequence[str], counts: Mapping, rows_per_file: int) -> DataFrame:
    """``df`` with a partition for each file to write, sorted; ``counts`` has the rows of each date."""
    files = files_of(counts, rows_per_file)
    bounds = _bounds(df, day_col, sort_cols, counts, files)
    key = F.struct(*[F.col(c) for c in sort_cols])

    def rank(day) -> Column:
        cuts = [F.struct(*[F.lit(v).cast(df.schema[c].dataType) for v, c in zip(cut, sort_cols)]) for cut in bounds.get(day, [])]
        return F.size(F.filter(F.array(*cuts), lambda cut: cut <= key)) if cuts else F.lit(0)

    number, first = F.lit(0), dict(zip(files, itertools.accumulate(files.values(), initial=0)))
    for day in files:
        number = F.when(F.col(day_col).eqNullSafe(F.lit(day)), F.lit(first[day]) + rank(day)).otherwise(number)
    return df.repartitionById(sum(files.values()), number.cast("int")).sortWithinPartitions(day_col, *sort_cols)

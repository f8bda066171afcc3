"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, as a file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, _UPPER, _UPPER.lower())


def text_bytes(values: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each text of an Arrow array, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    for v in values.cast(kind) if not pa.types.is_binary(values.type) else values:
        yield v.as_py()


def in_runs(values: Iterable, size, limit: int) -> Iterator[list]:
    """Consecutive lists whose ``size`` adds up to ``limit`` or little more, to bound what is held at once."""
    held, total = [], 0
    for v in values:
        held.append(v)
        total += size(v)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held

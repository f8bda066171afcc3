"""Replay of a table as a stream in batches that are known beforehand.

The file source takes what it finds, in the order of modification times, so which rows share a batch, and
with it what is late, depends on the moment.  Here each batch lands as a folder of its own (any number
of files, written by all executors), and the jobs are run to their end from their checkpoints before the
next one lands: batch by batch, like an application that is restarted after each.  A batch that has landed
whole is not written again, so a replay that broke off goes on where it was.

:func:`land_in_order` is for one run over data in the order of time: the files' modification times are set in the
order of their rows, and so many files a trigger make each batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from ticksmith.session import list_names, path_exists, set_times


def landed_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """The stream of all batches under ``path``, those to come included."""
    return spark.readStream.schema(schema).format(fmt).load(f"{path.rstrip('/')}/batch-*")


def land_in_order(df: DataFrame, path: str, time_col: str, files: int) -> None:
    """Land ``df`` in ``files`` files that follow one another in time.

    The file source takes files by modification time, which is set here (on file systems that have it: HDFS, local).
    """
    df.repartitionByRange(files, time_col).write.parquet(path)
    spark = df.sparkSession
    names = sorted(n for n in list_names(spark, path) if n.endswith(".parquet"))
    set_times(spark, [f"{path}/{n}" for n in names], first=1_000_000_000_000)


def ordered_stream(spark: SparkSession, path: str, schema, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def replay(spark: SparkSession, batches: Iterable[DataFrame], path: str, run: Callable[[], object], fmt: str = "parquet"):
    """Land each batch under ``path`` and call ``run`` (start the jobs, wait for their end); what it gave last."""
    out = None
    for i, batch in enumerate(batches):
        folder = f"{path.rstrip('/')}/batch-{i:06d}"
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            batch.write.mode("overwrite").format(fmt).save(folder)
        out = run()
    return out

"""The log of a streaming application's batches, kept in the shared folder.

A query's own reports (``recentProgress``) are a short list that a restart empties, so what they count, above
all the rows dropped as late, is lost with them.  :class:`ProgressLog` listens to the queries and
writes one small file for each of their batches, named by the query's id (that of its checkpoint, the same
after every restart) and the batch's number: a batch that runs again replaces its own file.

``dropped_rows`` is Spark's ``numRowsDroppedByWatermark``.  Ticks are added up by window and key before they
meet the state, so it counts a window and key of late ticks once a batch, however many ticks it had.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ticksmith.session import path_exists, put_text

SCHEMA = ("query_id string, name string, run_id string, batch_id long, at string, input_rows long, dropped_rows long, "
          "state_rows long, watermark string")


class ProgressLog(StreamingQueryListener):
    """One row for each batch of the queries it watches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.names: dict[str, str] = {}
        self._written: dict[tuple[str, int], str] = {}
        self._listening = False
        self._lock = threading.Lock()  # reports come from the listener's thread and from those that catch up

    # -- writing -------------------------------------------------------------
    def watch(self, name: str, query: StreamingQuery) -> None:
        self.names[str(query.id)] = name
        if not self._listening:
            self.spark.streams.addListener(self)
            self._listening = True
        self.catch_up(query)  # what it has reported before

    def catch_up(self, query: StreamingQuery) -> None:
        """Write what the query still remembers: reports reach listeners some time after the batch."""
        for progress in query.recentProgress:
            self.put(progress)

    def close(self) -> None:
        if self._listening:
            self.spark.streams.removeListener(self)
            self._listening = False

    def put(self, progress) -> None:
        with self._lock:
            self._put(progress)

    def _put(self, progress) -> None:
        query_id, batch_id = str(progress.id), int(progress.batchId)
        name, at = self.names.get(query_id), str(progress.timestamp)
        if name is None or self._written.get((query_id, batch_id), "") >= at:
            return
        operators = progress.stateOperators
        row = {
            "name": name, "run_id": str(progress.runId), "batch_id": batch_id, "at": at,
            "input_rows": int(progress.numInputRows), "dropped_rows": sum(int(o.numRowsDroppedByWatermark) for o in operators),
            "state_rows": sum(int(o.numRowsTotal) for o in operators), "watermark": (progress.eventTime or {}).get("watermark"),
        }
        put_text(self.spark, f"{self.path}/query_id={query_id}/batch-{batch_id:012d}.json", json.dumps(row))
        self._written[query_id, batch_id] = at

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.put(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    # -- reading -------------------------------------------------------------
    def read(self) -> DataFrame:
        """All rows ever written under this path, by this run or earlier ones."""
        return read_progress(self.spark, self.path)

    def dropped_late_rows(self) -> dict[str, int]:
        """The rows dropped as late since each watched query's checkpoint began."""
        found = self.read().where(F.col("query_id").isin(list(self.names))).groupBy("query_id").agg(F.sum("dropped_rows").alias("n"))
        counts = dict.fromkeys(self.names, 0) | {r.query_id: r.n for r in found.collect()}
        return {self.names[q]: n for q, n in counts.items()}


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def totals(progress: DataFrame) -> DataFrame:
    """``name, data_batches, input_rows, dropped_rows`` over all queries of a name."""
    return progress.groupBy("name").agg(
        F.count_if(F.col("input_rows") > 0).alias("data_batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_rows").alias("dropped_rows"))

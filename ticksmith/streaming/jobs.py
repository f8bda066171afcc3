"""Streaming window jobs: watermark -> tumbling aggregate -> keyed sink.

One query per :class:`~ticksmith.config.WindowSpec`.  They are kept
independent on purpose: a shared query would need the largest watermark for
all widths (delaying the 1-minute result), and chaining 1 -> 5 -> 10 minutes
would apply the 1-minute lateness to all and average means.

Per query:

* ``withWatermark(timestamp, delay)`` + ``groupBy(window, from, to)`` in
  append mode: a window is emitted once, when ``max(event time) - delay``
  passes its end; later rows for it are dropped (``numRowsDroppedByWatermark``).
* ``foreachBatch`` persists the batch and writes it through
  :class:`~ticksmith.sinks.keyed.KeyedTable` by batch id -- a replayed batch
  id replaces its own partitions, so it changes nothing, at O(batch) cost.
* A checkpoint per query under the shared folder (``spark.checkpoint.dir``):
  offsets, the commit log and the window state survive executor loss and
  driver restarts; open windows come out after a restart instead of being lost.

Scale: the state is keyed by (window, from, to).  The state store partition
count is ``spark.sql.shuffle.partitions`` *at the first start* and fixed
afterwards by the checkpoint, so choose it for the expected key count; the
RocksDB provider (see :func:`ticksmith.session.build_session`) keeps state off
heap.
"""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticksmith.config import WindowSpec
from ticksmith.operators.tumbling import tumbling
from ticksmith.session import make_folder
from ticksmith.sinks.keyed import DIRECT, KeyedTable
from ticksmith.streaming.progress import ProgressLog


def windowed_stream(ticks: DataFrame, spec: WindowSpec, dedup: bool = False) -> DataFrame:
    """The streaming aggregate of one job (watermark delay from the spec)."""
    return tumbling(ticks, spec.width, spec.aggs, watermark=spec.delay, dedup=dedup)


def stored_query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint: the same after every restart from it."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def batch_writer(sink: KeyedTable, schema=None, rejects=None, checkpoint: str | None = None):
    """``foreachBatch`` function: idempotent write of one micro-batch.

    With a sink ``schema`` the batch is first cast to it and rows that would
    violate it (NOT NULL, currency length) go to ``rejects`` instead of
    failing the write.
    """

    owner: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not owner:
            owner.append(stored_query_id(batch.sparkSession, checkpoint) if checkpoint else DIRECT)
        # every action on the batch re-runs the stateful plan, and more than one job reads it
        batch.persist()
        try:
            out = batch
            if schema is not None:
                from pyspark.sql import functions as F

                from ticksmith.sinks.contract import conform

                out, bad = conform(batch, schema)
                # the batch is cached, so probing for rejects is cheap; most
                # batches have none and skip a write job
                if rejects is not None and not bad.isEmpty():
                    rejects.append(
                        bad.select("reason", F.to_json(F.struct(*schema.fieldNames())).alias("raw")), batch_id, owner[0]
                    )
            sink.append_new(out, batch_id, owner[0], unique=True)  # a window and its key are one row of the batch
        finally:
            batch.unpersist()

    return write


def start_window_query(
    ticks: DataFrame,
    spec: WindowSpec,
    sink: KeyedTable,
    checkpoint: str,
    trigger: dict | None = None,
    query_name: str | None = None,
    dedup: bool = False,
    schema=None,
    rejects=None,
) -> StreamingQuery:
    """Start one append-mode window job.

    ``trigger``: ``None`` runs micro-batches back to back (the original's
    default); ``{"processingTime": "30 seconds"}`` for a fixed cadence;
    ``{"availableNow": True}`` to work off what is there (plus one no-data batch
    that emits windows due by the watermark) and stop.
    """
    w = (
        windowed_stream(ticks, spec, dedup=dedup)
        .writeStream.outputMode("append")
        .foreachBatch(batch_writer(sink, schema, rejects, checkpoint))
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


@dataclass
class JobReport:
    """How a supervised job came out: ``ended``, ``failed``, ``stopped`` (it had nothing left to do) or ``late`` (it had)."""

    state: str = "running"
    restarts: int = 0
    error: str | None = None


def _busy(query: StreamingQuery) -> bool:
    return query.isActive and (query.status["isDataAvailable"] or query.status["isTriggerActive"])


@dataclass
class JobGroup:
    """Several streaming queries started together (fan-out from one source)."""

    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    tables: dict = field(default_factory=dict)
    log: ProgressLog | None = None
    starters: dict[str, Callable[[], StreamingQuery]] = field(default_factory=dict)

    def add(self, name: str, start: Callable[[], StreamingQuery]) -> None:
        """Start a query, and keep how: it can be started again from its checkpoint."""
        self.starters[name] = start
        query = self.queries[name] = start()
        if self.log is not None:
            self.log.watch(name, query)

    def _ended(self) -> None:
        """Write what the queries have reported last."""
        if self.log is not None:
            for q in self.queries.values():
                self.log.catch_up(q)
            if not any(q.isActive for q in self.queries.values()):
                self.log.close()

    def await_all(self, timeout: float | None = None) -> None:
        """Wait for every query (e.g. ``availableNow`` runs); re-raise the first failure.

        Raises ``TimeoutError`` naming the queries that still run when the time is up; they go on.
        """
        deadline = None if timeout is None else time.monotonic() + timeout
        try:
            for name, q in self.queries.items():
                try:
                    if deadline is None:
                        q.awaitTermination()
                    else:
                        q.awaitTermination(max(0.1, deadline - time.monotonic()))
                except Exception as e:
                    self.stop_all()
                    raise RuntimeError(f"window job {name!r} failed") from e
        finally:
            self._ended()
        late = [name for name, q in self.queries.items() if q.isActive]
        if late:
            raise TimeoutError(f"still running after {timeout} seconds: {', '.join(late)}")

    def await_any(self, timeout: float | None = None, poll: float = 1.0) -> str | None:
        """Block until one of *these* queries ends; return its name (None on timeout).

        If it failed, stop the others and raise, naming it.  Only this group's
        queries are watched (the session-wide ``awaitAnyTermination`` would
        also return for any other query that ended in the same session).
        """
        deadline = None if timeout is None else time.monotonic() + timeout
        while True:
            for name, q in self.queries.items():
                if not q.isActive:
                    exc = q.exception()
                    if exc is not None:
                        self.stop_all()
                        raise RuntimeError(f"window job {name!r} failed: {exc}")
                    return name
            if deadline is not None and time.monotonic() >= deadline:
                return None
            time.sleep(poll)

    def supervise(
        self, seconds: float | None = None, restarts: int = 0, drain: float = 30.0, poll: float = 0.2,
    ) -> dict[str, JobReport]:
        """Watch the jobs until all have ended, one has failed for good or the time is up; then drain and stop the rest.

        A job that fails starts again from its checkpoint, ``restarts`` times at most.  Draining gives the jobs
        that still run up to ``drain`` seconds to work off what has come.
        """
        reports = {name: JobReport() for name in self.queries}
        deadline = None if seconds is None else time.monotonic() + seconds

        def look(name: str, may_restart: bool) -> None:
            query, report = self.queries[name], reports[name]
            if report.state != "running" or query.isActive:
                return
            error = query.exception()
            if error is None:
                report.state = "ended"
                return
            report.error = str(error)
            if may_restart and report.restarts < restarts:
                report.restarts += 1
                if self.log is not None:
                    self.log.catch_up(query)
                self.add(name, self.starters[name])
            else:
                report.state = "failed"

        while True:
            for name in reports:
                look(name, True)
            states = [r.state for r in reports.values()]
            if "running" not in states or "failed" in states or (deadline is not None and time.monotonic() >= deadline):
                break
            time.sleep(poll)
        limit = time.monotonic() + drain
        for name, report in reports.items():
            query = self.queries[name]
            while report.state == "running" and _busy(query) and time.monotonic() < limit:
                time.sleep(poll)
            look(name, False)
            if report.state == "running":
                report.state = "late" if _busy(query) else "stopped"
                query.stop()
        self._ended()
        return reports

    def stop_all(self) -> None:
        for q in self.queries.values():
            if q.isActive:
                q.stop()
        self._ended()

    def dropped_late_rows(self) -> dict[str, int]:
        """Rows dropped by the watermark, per query, since its checkpoint began: from the log of all runs."""
        if self.log is None:
            raise ValueError("these queries have no progress log")
        self._ended()
        return {name: n for name, n in self.log.dropped_late_rows().items() if name in self.queries}


def start_window_jobs(
    ticks: DataFrame,
    specs: Iterable[WindowSpec],
    sinks: dict[str, KeyedTable],
    checkpoint_root: str,
    trigger: dict | None = None,
    dedup: bool = False,
    rejects_root: str | None = None,
    group: JobGroup | None = None,
) -> JobGroup:
    """Fan out: one independent query per spec from the same tick stream.

    Each query gets its own source reader, watermark, state and checkpoint
    (``<checkpoint_root>/<spec.name>``).  With ``rejects_root`` every batch is
    held to its sink schema; violating rows go to ``<rejects_root>/<name>``.
    Every batch of every query is logged under ``<checkpoint_root>/progress``.
    """
    from ticksmith.schema import sink_schema_for
    from ticksmith.sinks.keyed import QuarantineTable

    root = checkpoint_root.rstrip("/")
    group = group or JobGroup(log=ProgressLog(ticks.sparkSession, f"{root}/progress"))
    for spec in specs:
        group.add(spec.name, functools.partial(
            start_window_query,
            ticks,
            spec,
            sinks[spec.name],
            f"{root}/{spec.name}",
            trigger=trigger,
            query_name=None,
            dedup=dedup,
            schema=sink_schema_for(spec.aggs) if rejects_root else None,
            rejects=QuarantineTable(f"{rejects_root.rstrip('/')}/{spec.name}") if rejects_root else None,
        ))
    return group


def start_quarantine_query(
    tagged: DataFrame,
    sink,
    checkpoint: str,
    trigger: dict | None = None,
    raw_col: str = "_raw",
) -> StreamingQuery:
    """Append rejected records (``reason`` + the raw text) to a quarantine table.

    Stateless, so every bad record is written in the batch it arrives in; the
    table overwrites a replayed batch id's partition instead of duplicating it.
    """
    from pyspark.sql import functions as F

    bad = tagged.where(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), F.col(raw_col).cast("string").alias("raw")
    )

    owner: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not owner:
            owner.append(stored_query_id(batch.sparkSession, checkpoint))
        sink.append(batch, batch_id, owner[0])

    w = bad.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


PARSED = "`from` string, `to` string, timestamp timestamp, rate double, reason string, raw string, kind string"
TICK, REJECT = "tick", "reject"


def start_parse_query(tagged: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, raw_col: str = "_raw") -> StreamingQuery:
    """The one query that reads and parses the source: ticks and rejects to the folders of ``path`` by ``kind``.

    It writes through Spark's file sink, whose log names the files of every committed batch: readers of the folder
    (stream or batch) see whole batches and each once, also after a crash in the middle of one.
    """
    from pyspark.sql import functions as F

    bad = F.col("_reason").isNotNull()
    rows = tagged.select(
        "from", "to", "timestamp", "rate", F.col("_reason").alias("reason"),
        F.when(bad, F.col(raw_col).cast("string")).alias("raw"), F.when(bad, REJECT).otherwise(TICK).alias("kind"))
    # with its log in place a reader never takes the folder for one of plain files, not even before the first batch
    make_folder(tagged.sparkSession, f"{path}/_spark_metadata")
    w = rows.writeStream.outputMode("append").format("parquet").partitionBy("kind").option("path", path).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def parsed_ticks(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The stream of ticks that a parse query has committed (rejects are not read)."""
    reader = spark.readStream.schema(PARSED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path).where(f"kind = '{TICK}'").select("from", "to", "timestamp", "rate")


def parsed_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``reason, raw`` of the rejects that a parse query has committed."""
    return spark.read.schema(PARSED).parquet(path).where(f"kind = '{REJECT}'").select("reason", "raw")


def start_tagged_jobs(
    tagged: DataFrame,
    specs: Iterable[WindowSpec],
    table_root: str,
    checkpoint_root: str,
    trigger: dict | None = None,
    dedup: bool = False,
    quarantine: bool = True,
    raw_col: str = "_raw",
    parse_once: bool = False,
) -> JobGroup:
    """Window jobs + quarantine over a tagged tick stream.

    ``tagged`` has ``from, to, timestamp, rate``, a ``_reason`` (NULL = good)
    and the raw record in ``raw_col``.  Tables go to
    ``<table_root>/<sink_table>``, checkpoints to ``<checkpoint_root>/<name>``.

    Each job reads and parses the source for itself, unless ``parse_once``: then one
    query does, and commits ticks and rejects to ``<table_root>/parsed``, which the window
    jobs read (:func:`start_parse_query`; the rejects lie there, not in a quarantine table).
    """
    from ticksmith.operators.quality import split
    from ticksmith.sinks.keyed import QuarantineTable

    specs = list(specs)
    root = table_root.rstrip("/")
    group = JobGroup(log=ProgressLog(tagged.sparkSession, f"{checkpoint_root.rstrip('/')}/progress"))
    if parse_once:
        parsed, quarantine = f"{root}/parsed", False
        group.add("parse", functools.partial(
            start_parse_query, tagged, parsed, f"{checkpoint_root.rstrip('/')}/parse", trigger, raw_col))
        if trigger and trigger.get("availableNow"):
            group.await_all()  # the others work off what it has committed
        good = parsed_ticks(tagged.sparkSession, parsed)
    else:
        good, _ = split(tagged)
    sinks = {
        s.name: KeyedTable(f"{root}/{s.sink_table}", by_batch=True, conflicts=QuarantineTable(f"{root}/conflicts/{s.name}")) for s in specs}
    group = start_window_jobs(
        good, specs, sinks, checkpoint_root, trigger=trigger, dedup=dedup, rejects_root=f"{root}/rejects", group=group
    )
    if quarantine:
        group.add("quarantine", functools.partial(
            start_quarantine_query,
            tagged,
            QuarantineTable(f"{root}/quarantine"),
            f"{checkpoint_root.rstrip('/')}/quarantine",
            trigger=trigger,
            raw_col=raw_col,
        ))
    group.tables = sinks
    return group


def start_message_jobs(messages: DataFrame, specs: Iterable[WindowSpec], table_root: str,
                       checkpoint_root: str, **kw) -> JobGroup:
    """The streaming application over flat tick messages (``value`` column):
    parse with the tick schema, quarantine bad messages, window jobs."""
    from ticksmith.functions.ticks_json import tag_ticks

    return start_tagged_jobs(tag_ticks(messages), specs, table_root, checkpoint_root, **kw)


def start_response_jobs(responses: DataFrame, specs: Iterable[WindowSpec], table_root: str,
                        checkpoint_root: str, **kw) -> JobGroup:
    """The same over raw quote responses (``symbol, currency, body``): status
    check and quote lookup instead of the flat message parse."""
    from pyspark.sql import functions as F

    from ticksmith.functions.quotes import flatten_all, flatten_requested

    body = responses.withColumn("_raw", F.col("body").cast("string"))
    if "symbol" in responses.columns and "currency" in responses.columns:
        tagged = flatten_requested(body, keep=("_raw",))
    else:
        tagged = flatten_all(body, keep=("_raw",))
    return start_tagged_jobs(tagged, specs, table_root, checkpoint_root, **kw)


def start_publish_job(responses: DataFrame, options: dict[str, str], checkpoint: str, fmt: str = "kafka", trigger: dict | None = None) -> StreamingQuery:
    """The producer as a job: landed responses -> status check and quote -> keyed messages, to a topic or (``fmt="json"``) to files.

    The quote's own time goes into the message as it stands; responses that are set aside give no message.
    """
    from ticksmith.functions.quotes import flatten_all, flatten_requested
    from ticksmith.operators.quality import split
    from ticksmith.sinks.messages import message_frame, stream_messages

    flat = flatten_requested(responses) if {"symbol", "currency"} <= set(responses.columns) else flatten_all(responses)
    good, _ = split(flat, good_columns=("from", "to", "timestamp_text", "rate"))
    return stream_messages(message_frame(good, ts_col="timestamp_text"), options, checkpoint, fmt, trigger)

"""Keyed, idempotent writes of finished windows.

The original appended every micro-batch to a table with a primary key, so a
replayed batch (restart after a crash between write and offset commit) would
fail on the key, and so would a row whose key is stored with other values.
Two idempotent write paths, one layout:

* Streamed tables (``by_batch=True``): in append mode every window is emitted
  exactly once, so only a *replay of the same batch id* can duplicate rows.
  Each batch is written into ``window_date=<d>/query_id=<q>/batch_id=<n>`` partitions with
  dynamic partition overwrite: a replay replaces exactly its own partitions
  (also after a half-finished attempt).  Cost is O(batch); what is stored is
  read only under dates that another query, a backfill or a compaction has written.
* Keyed tables (``by_batch=False``): :meth:`KeyedTable.append_new` stores only
  rows whose key is not stored yet, for batches that may overlap earlier ones.
  :meth:`KeyedTable.backfill` replaces whole dates (dynamic overwrite).

A key is stored once.  Equal rows of a key count as one; where rows of a key differ, within a batch or from the
stored one, none of them can be told to be right: what is stored stays, and the others go to
the table of ``conflicts`` with the reason, or, if there is none, the write is refused.

Layout: Parquet partitioned by ``window_date`` (date of ``window_start``),
a set number of files for each date (:mod:`ticksmith.sinks.layout`), sorted by ``from_currency, window_start``; the read side's
predicates (coin, time range) prune partitions and row groups, and
:meth:`KeyedTable.read_range` lists only the folders of the requested dates.
The many small folders of a streamed table are merged by :meth:`KeyedTable.compact`
(:mod:`ticksmith.sinks.manifest`); read such a table through this class.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.functions.timecols import as_ntz
from ticksmith.schema import SINK_KEY
from ticksmith.session import delete_path, list_folders
from ticksmith.sinks import manifest
from ticksmith.sinks.contract import assert_unique
from ticksmith.sinks.layout import in_files

PARTITION_COL = "window_date"
BATCH_COL = "batch_id"
# A streamed batch lies under the id of its query (kept in the query's checkpoint):
# batch numbers start again at 0 with a new checkpoint.
QUERY_COL = "query_id"
DIRECT, BACKFILL, COMPACT = "direct", "backfill", "compacted"
RUN_COL = "run"
IN_BATCH, FROM_STORED = "differs within the batch", "differs from the stored row"


class KeyedTable:
    """A Parquet table of windowed rows with a unique key."""

    def __init__(
        self,
        path: str,
        key: Sequence[str] = SINK_KEY,
        time_col: str = "window_start",
        partition_col: str = PARTITION_COL,
        sort_cols: Sequence[str] = ("from_currency", "window_start"),
        check_unique: bool = False,
        by_batch: bool = False,
        conflicts: QuarantineTable | None = None,
        rows_per_file: int = 1_000_000,
    ):
        self.path = path.rstrip("/")
        self.key = list(key)
        self.time_col = time_col
        self.partition_col = partition_col
        self.sort_cols = list(sort_cols)
        self.check_unique = check_unique
        self.by_batch = by_batch
        self.conflicts = conflicts
        self.rows_per_file = rows_per_file
        self._exists = False

    @property
    def hidden_columns(self) -> list[str]:
        """Layout columns that are not part of the rows."""
        return [self.partition_col] + ([QUERY_COL, BATCH_COL] if self.by_batch else [])

    # -- reading -------------------------------------------------------------
    def exists(self, spark: SparkSession) -> bool:
        """Whether a date was ever stored."""
        self._exists = self._exists or bool(self._days(spark))
        return self._exists

    def _days(self, spark: SparkSession) -> list[dt.date]:
        """The dates that have a folder."""
        return [day for day, _ in self._day_folders(spark)]

    def _day_folders(self, spark: SparkSession) -> list[tuple[dt.date, str]]:
        named = (f.partition("=") + (f,) for f in list_folders(spark, self.path))
        return [(_day(value), folder) for name, _, value, folder in named if name == self.partition_col and not value.startswith("__")]

    def _batch_folders(self, spark: SparkSession, day: dt.date) -> list[str]:
        """The ``query_id=.../batch_id=...`` folders of a date of a streamed table."""
        at = f"{self.path}/{self.partition_col}={day}"
        return [f"{q}/{b}" for q in list_folders(spark, at) if q.startswith(QUERY_COL) for b in list_folders(spark, f"{at}/{q}")]

    def _scan(self, spark: SparkSession, days: Sequence[dt.date] | None = None) -> DataFrame | None:
        """What counts of the table (of some dates), with the layout columns; None if nothing is stored.

        Of a date that was compacted, the compacted rows and the batches that came after.
        """
        compacted = manifest.latest(spark, self.path)[1] if self.by_batch else {}
        if days is None and not compacted:
            return spark.read.parquet(self.path)
        wanted = None if days is None else set(days)
        plain, merged = [], []
        for day, folder in self._day_folders(spark):
            if wanted is not None and day not in wanted:
                continue
            if str(day) in compacted:
                replaced = set(compacted[str(day)]["replaced"])
                plain += [f"{self.path}/{folder}/{f}" for f in self._batch_folders(spark, day) if f not in replaced]
            else:
                plain.append(f"{self.path}/{folder}")
        root = f"{self.path}/{manifest.COMPACTED}"
        for day, entry in compacted.items():
            if wanted is None or _day(day) in wanted:
                merged.append(f"{root}/{self.partition_col}={day}/{RUN_COL}={entry['run']}")
        frames = [spark.read.option("basePath", base).parquet(*paths) for base, paths in ((self.path, plain), (root, merged)) if paths]
        frames = [f.drop(RUN_COL).withColumn(QUERY_COL, F.col(QUERY_COL).cast("string")) if self.by_batch else f for f in frames]
        return frames[0].unionByName(frames[1]) if len(frames) > 1 else frames[0] if frames else None

    def read(self, spark: SparkSession, keep_partition_col: bool = False) -> DataFrame:
        df = self._scan(spark)
        return df if keep_partition_col else df.drop(*self.hidden_columns)

    def read_range(self, spark: SparkSession, start, end) -> DataFrame:
        """Rows with ``start <= window_start <= end``.

        Only the folders of the requested dates are read, so the cost does not grow with the
        table's history; the partition and row predicates are applied on top.
        """
        d0, d1 = _day(start), _day(end)
        df = self._scan(spark, [d0 + dt.timedelta(days=i) for i in range((d1 - d0).days + 1)])
        if df is None:  # none of the dates is stored
            df = self._scan(spark)
        df = df.where(
            F.col(self.partition_col).between(F.lit(d0), F.lit(d1))
            & F.col(self.time_col).between(as_ntz(start), as_ntz(end))
        )
        return df.drop(*self.hidden_columns)

    # -- writing -------------------------------------------------------------
    def _with_partition(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.partition_col, F.to_date(F.col(self.time_col)))

    def _settle(self, batch: DataFrame, stored: DataFrame | None, batch_id: int | None, query_id: str) -> DataFrame:
        """The rows to store, one of each key that is not stored; rows that differ go to the conflicts.

        One aggregate by key finds the lowest and the highest version of a key, which are the same unless rows differ.
        """
        values = [c for c in batch.columns if c not in self.key]
        row = F.struct(*[F.col(c) for c in values])
        judged = batch.groupBy(*self.key).agg(F.min(row).alias("_lo"), F.max(row).alias("_hi"))
        if stored is not None:
            judged = judged.join(stored.select(*self.key, row.alias("_old"), F.lit(True).alias("_known")), self.key, "left")
        else:
            judged = judged.withColumns({"_old": F.lit(None).cast(judged.schema["_lo"].dataType), "_known": F.lit(None).cast("boolean")})
        judged = judged.withColumn("_reason", F.when(~F.col("_lo").eqNullSafe(F.col("_hi")), F.lit(IN_BATCH)).when(
            F.col("_known") & ~F.col("_lo").eqNullSafe(F.col("_old")), F.lit(FROM_STORED)))
        disputed = judged.where(F.col("_reason").isNotNull()).select(*self.key, "_old", "_known", "_reason")
        bad = batch.join(disputed, self.key).where(F.col("_known").isNull() | ~row.eqNullSafe(F.col("_old"))).select(
            *batch.columns, F.col("_reason").alias("reason")).distinct()
        if self.conflicts is not None:
            self.conflicts.append_if_any(bad, batch_id, query_id)
        else:
            found = bad.limit(5).collect()
            if found:
                raise ValueError(f"rows with one key {self.key} that differ: {[tuple(r) for r in found]}")
        new = judged.where(F.col("_reason").isNull() & F.col("_known").isNull())
        return new.select(*[F.col(c) if c in self.key else F.col("_lo")[c].alias(c) for c in batch.columns])

    def _counts(self, rows: DataFrame) -> dict:
        """The rows of each date."""
        return {r[0]: r[1] for r in self._with_partition(rows).groupBy(self.partition_col).count().collect()}

    def write_batch(self, batch: DataFrame, batch_id: int, query_id: str = DIRECT, unique: bool = False) -> None:
        """Write one micro-batch, idempotently by ``query_id`` and ``batch_id``.

        Dynamic partition overwrite of the ``(window_date, query_id, batch_id)``
        partitions the batch produces: a replay of the batch id (same input
        offsets, same state version, same rows) replaces them and nothing else.
        Keys that another query, a backfill or a compaction has stored under the batch's dates
        stay as they are.  ``unique``: no key stands twice in the batch, as its rows are groups by key.
        """
        spark = batch.sparkSession
        counts = self._counts(batch)
        if not counts:
            return  # never create a table without data files (its schema could not be read)
        compacted = manifest.latest(spark, self.path)[1]
        others = [
            day for day in counts if day is not None and (str(day) in compacted or any(
                f != f"{QUERY_COL}={query_id}" for f in list_folders(spark, f"{self.path}/{self.partition_col}={day}")))]
        stored = self._scan(spark, others) if others else None
        if stored is not None:
            stored = stored.where(F.col(QUERY_COL) != query_id)
        rows = batch if unique and stored is None else self._settle(batch, stored, batch_id, query_id)
        out = self._with_partition(rows).withColumn(QUERY_COL, F.lit(query_id)).withColumn(BATCH_COL, F.lit(int(batch_id)).cast("long"))
        (
            in_files(out, self.partition_col, self.sort_cols, counts, self.rows_per_file)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.partition_col, QUERY_COL, BATCH_COL)
            .parquet(self.path)
        )
        self._exists = True

    def _stored_between(self, spark: SparkSession, lo, hi) -> DataFrame | None:
        """What is stored of a range of times, to be compared with a batch."""
        if not self.exists(spark):
            return None
        return spark.read.parquet(self.path).where(
            F.col(self.partition_col).between(F.to_date(as_ntz(lo)), F.to_date(as_ntz(hi)))
            & F.col(self.time_col).between(as_ntz(lo), as_ntz(hi)))

    def new_rows(self, batch: DataFrame, batch_id: int | None = None, query_id: str = DIRECT) -> DataFrame | None:
        """The rows of ``batch`` to store (None if the batch is empty)."""
        bounds = batch.agg(F.min(self.time_col).alias("lo"), F.max(self.time_col).alias("hi")).first()
        if bounds is None or bounds["lo"] is None:
            return None
        return self._settle(batch, self._stored_between(batch.sparkSession, *bounds), batch_id, query_id)

    def append_new(self, batch: DataFrame, batch_id: int | None = None, query_id: str = DIRECT, unique: bool = False) -> None:
        """Idempotent append.

        Streamed tables write by batch id (:meth:`write_batch`).  Keyed tables
        skip rows already stored; call on a persisted frame (more than one job runs on it).
        """
        if self.check_unique:
            assert_unique(batch, self.key)
        if self.by_batch:
            if batch_id is None:
                raise ValueError("a streamed table needs the batch id")
            self.write_batch(batch, batch_id, query_id, unique)
            return
        df = self.new_rows(batch, batch_id, query_id)
        if df is None:
            return
        (
            in_files(self._with_partition(df), self.partition_col, self.sort_cols, self._counts(batch), self.rows_per_file)
            .write.mode("append")
            .partitionBy(self.partition_col)
            .parquet(self.path)
        )
        self._exists = True

    def compact(self, spark: SparkSession, first_day, last_day) -> list[dt.date]:
        """Merge the batch folders of the dates from ``first_day`` to ``last_day`` into a few sorted files for each date.

        Streams may go on writing, and readers through this class reading: the rows are written beside the
        table, and count from the moment the manifest names them in place of the folders they replace.
        The dates that were merged are returned; one that another compaction took meanwhile is left to it.
        """
        if not self.by_batch:
            raise ValueError("only a streamed table has batch folders")
        lo, hi = _day(first_day), _day(last_day)
        _, before = manifest.latest(spark, self.path)
        folders = {day: self._batch_folders(spark, day) for day in self._days(spark) if lo <= day <= hi}
        folders = {day: fs for day, fs in folders.items() if len(set(fs) - set(before.get(str(day), {}).get("replaced", ()))) > (str(day) not in before)}
        if not folders:
            return []
        rows = self._scan(spark, list(folders))
        run, root = uuid.uuid4().hex, f"{self.path}/{manifest.COMPACTED}"
        rows = rows.drop(QUERY_COL, BATCH_COL)
        counts = {r[0]: r[1] for r in rows.groupBy(self.partition_col).count().collect()}
        out = in_files(rows, self.partition_col, self.sort_cols, counts, self.rows_per_file)
        out.withColumns({RUN_COL: F.lit(run), QUERY_COL: F.lit(COMPACT), BATCH_COL: F.lit(0).cast("long")}).write.mode("append").partitionBy(
            self.partition_col, RUN_COL, QUERY_COL, BATCH_COL).parquet(root)

        def update(days: dict) -> dict:
            # names of folders that are gone need not be kept
            return days | {str(day): {"run": run, "replaced": sorted(fs)} for day, fs in folders.items()
                           if days.get(str(day)) == before.get(str(day))}

        days = manifest.change(spark, self.path, update)
        return sorted(day for day in folders if days[str(day)]["run"] == run)

    def vacuum(self, spark: SparkSession) -> int:
        """Remove folders that a compaction has replaced or left without a commit; how many they were.

        For a time when no compaction runs and no reader is left that began before the last one.
        """
        _, days = manifest.latest(spark, self.path)
        gone = [f"{self.path}/{self.partition_col}={day}/{f}" for day, entry in days.items()
                for f in set(entry["replaced"]) & set(self._batch_folders(spark, _day(day)))]
        root = f"{self.path}/{manifest.COMPACTED}"
        for folder in list_folders(spark, root):
            held = days.get(folder.partition("=")[2], {}).get("run")
            gone += [f"{root}/{folder}/{r}" for r in list_folders(spark, f"{root}/{folder}") if r != f"{RUN_COL}={held}"]
        return sum(delete_path(spark, path) for path in gone)

    def backfill(self, df: DataFrame, files_per_date: int | None = None, first_day=None, last_day=None) -> None:
        """Replace the dates present in ``df`` (batch recompute; idempotent), and
        remove those from ``first_day`` to ``last_day`` that ``df`` has no rows for.

        A streamed table gets the rows under the name of a query of their own; what
        streams had stored under these dates is removed after the write, so a crash
        in between leaves both and a second run repairs it.

        Range partitioning on (date, coin, start) samples the keys, so a date or
        coin holding a large share of rows is split over several tasks instead
        of landing in one; dynamic partition overwrite replaces only touched dates.
        """
        out = self._with_partition(df)
        cols = [self.partition_col, *self.sort_cols]
        layout = [self.partition_col]
        if self.by_batch:
            out = out.withColumn(QUERY_COL, F.lit(BACKFILL)).withColumn(BATCH_COL, F.lit(0).cast("long"))
            layout = self.hidden_columns
        spark, days = df.sparkSession, None
        if self.by_batch or first_day is not None or last_day is not None:
            days = {r[0] for r in out.select(self.partition_col).distinct().collect()}
        out = out.repartitionByRange(files_per_date, *cols) if files_per_date else out.repartitionByRange(*cols)
        (
            out.sortWithinPartitions(*cols)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*layout)
            .parquet(self.path)
        )
        self._exists = True
        if days is not None:
            if self.by_batch:  # compacted rows of these dates count no more
                manifest.change(spark, self.path, lambda known: {
                    d: e for d, e in known.items() if _day(d) not in days and not self._ranged(_day(d), first_day, last_day)})
            self._remove_replaced(spark, days, first_day, last_day)

    @staticmethod
    def _ranged(day: dt.date, first_day, last_day) -> bool:
        """Whether a date lies in a range of which one end was given at least."""
        if first_day is None and last_day is None:
            return False
        return _day(first_day or dt.date.min) <= day <= _day(last_day or dt.date.max)

    def _remove_replaced(self, spark: SparkSession, days: set, first_day, last_day) -> None:
        """Folders that a backfill of ``days`` has replaced, and those of dates in the range without rows."""
        for day, folder in self._day_folders(spark):
            if day in days:
                for inner in list_folders(spark, f"{self.path}/{folder}") if self.by_batch else []:
                    if inner != f"{QUERY_COL}={BACKFILL}":
                        delete_path(spark, f"{self.path}/{folder}/{inner}")
            elif self._ranged(day, first_day, last_day):
                delete_path(spark, f"{self.path}/{folder}")


def publish_days(spark: SparkSession, streamed: KeyedTable, serving: KeyedTable, first_day, last_day) -> None:
    """Copy closed days of a streamed table into a date-partitioned serving table.

    The streamed table holds one folder per (date, micro-batch); the serving
    table holds each date range-partitioned into a few sorted files.  Dates
    are replaced whole by dynamic partition overwrite, so a re-run (after a
    crash, or after late corrections) is safe: the source is never modified.
    """
    if serving.by_batch:
        raise ValueError("the serving table must be date-partitioned only")
    start = dt.datetime.combine(_day(first_day), dt.time())
    end = dt.datetime.combine(_day(last_day), dt.time(23, 59, 59, 999999))
    serving.backfill(streamed.read_range(spark, start, end))


def _day(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.fromisoformat(str(value)).date()


class QuarantineTable:
    """Store of rejected rows with reason, partitioned by query and batch id.

    A replayed batch id overwrites its own partition (dynamic partition
    overwrite), so a replay never duplicates quarantined rows.
    """

    def __init__(self, path: str):
        self.path = path

    def append(self, bad: DataFrame, batch_id: int | None = None, query_id: str = DIRECT) -> None:
        out = bad.withColumn(QUERY_COL, F.lit(query_id)).withColumn(
            BATCH_COL, F.lit(-1 if batch_id is None else batch_id).cast("long"))
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(QUERY_COL, BATCH_COL)
            .parquet(self.path)
        )

    def append_if_any(self, bad: DataFrame, batch_id: int | None = None, query_id: str = DIRECT) -> None:
        """``append``, without a write for nothing."""
        if not bad.isEmpty():
            self.append(bad, batch_id, query_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """Stored rejects; empty (``reason, raw, query_id, batch_id``) if none was ever stored."""
        try:
            return spark.read.parquet(self.path)
        except AnalysisException:
            return spark.createDataFrame([], "reason string, raw string, query_id string, batch_id bigint")


class JdbcKeyedTable(KeyedTable):
    """The same idempotent append against a relational table over JDBC.

    The comparison reads back only the rows of the batch's time
    range (the predicate is pushed into the database's WHERE).  Credentials
    come from ``props``, never from code.
    """

    def __init__(self, url: str, table: str, key: Sequence[str] = SINK_KEY, conflicts: QuarantineTable | None = None, **props: str):
        super().__init__(path=table, key=key, conflicts=conflicts)
        self.url, self.table, self.props = url, table, props

    def _reader(self, spark: SparkSession):
        return spark.read.format("jdbc").option("url", self.url).option("dbtable", self.table).options(**self.props)

    def exists(self, spark: SparkSession) -> bool:
        return True

    def _stored_between(self, spark: SparkSession, lo, hi) -> DataFrame:
        return self._reader(spark).load().where(F.col(self.time_col).between(as_ntz(lo), as_ntz(hi)))

    def append_new(self, batch: DataFrame, batch_id: int | None = None, query_id: str = DIRECT, unique: bool = False) -> None:
        df = self.new_rows(batch, batch_id, query_id)
        if df is None:
            return
        (
            df.write.format("jdbc")
            .option("url", self.url)
            .option("dbtable", self.table)
            .options(**self.props)
            .mode("append")
            .save()
        )

"""Session helpers: time zone pinning and the shared folder for written state.

Cluster rules this module enforces:

* Written intermediate tables and streaming checkpoints live under the shared
  folder the cluster names in ``spark.checkpoint.dir``.  We only pick a folder
  of our own when the session has none (local tests).
* The engine's wall-clock columns are ``TIMESTAMP_NTZ`` read as UTC, so the
  session time zone is pinned to UTC before any NTZ <-> instant conversion.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: dict[str, str] = {}


def build_session(
    master: str | None = None,
    app: str = "ticksmith",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """A session with the settings the engine relies on.

    On a cluster leave ``master`` unset (spark-submit decides) and size
    ``shuffle_partitions`` to the data: roughly input bytes / 128 MB for batch
    roll-ups.  AQE coalesces small partitions and splits skewed ones at run
    time, so the number is an upper bound rather than a guess that must be right.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # RocksDB keeps streaming window state off the JVM heap, so the number of
        # open (window, key) groups can grow far beyond executor memory.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Interpret wall-clock (NTZ) timestamps as UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _configured_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext on this side (Spark Connect)
            root = None
    return root.rstrip("/") if root else None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the SparkContext).

    Raises when the session names none: a folder of our own choosing would be
    local to one machine, and the executors of a cluster could not share it.
    """
    root = _configured_root(spark)
    if not root:
        raise RuntimeError(
            "no shared folder: set spark.checkpoint.dir to a path that the driver and "
            "all executors can reach"
        )
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """``checkpoint_root``, naming a temporary folder first if the master is local and none is set.

    For tests, benchmarks and smoke checks in one JVM only; on any other master a
    missing setting still raises.
    """
    if not _configured_root(spark) and spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ticksmith-"))
    return checkpoint_root(spark)


def _own_root(spark: SparkSession) -> str:
    """The folder under the shared one that belongs to this application."""
    return f"{checkpoint_root(spark)}/ticksmith/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path for staged copies under the application's own part of the shared folder.

    ``unique`` appends a fresh run id.  ``drop_staged`` removes everything that
    was handed out, so the application id is the owner of all staged copies.
    """
    segs = [_own_root(spark), *(p.strip("/") for p in parts)]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(segs)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors, once per application.

    Not needed where it is installed or on the workers' ``PYTHONPATH``; harmless there.
    """
    context = spark.sparkContext
    if _SHIPPED.get("to") == context.applicationId:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ticksmith-"), "ticksmith_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED["to"] = context.applicationId


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder through the Hadoop file system that owns it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if there is no such folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names of all that is in a folder; none if there is no such folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def set_times(spark: SparkSession, paths: list[str], first: int) -> None:
    """Set the files' modification times (ms since 1970) a second apart, in the order given."""
    for i, path in enumerate(paths):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(p, first + 1000 * i, -1)


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file under a temporary name and rename it, so that no reader meets half of it.

    Without ``replace`` a file of that name stays as it is; False says that there was one.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}.tmp")
    files = target.getFileSystem(conf)
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if replace else kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(
            files.makeQualified(draft), files.makeQualified(target), options)
    except Exception as e:
        files.delete(draft, False)
        if not replace and files.exists(target):
            return False
        raise e
    return True


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder or a file; one that does not exist is an error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory())


def drop_staged(spark: SparkSession) -> bool:
    """Remove every staged copy of this application; call it when its results have been read."""
    return delete_path(spark, _own_root(spark))


def staged(df: DataFrame, *parts: str) -> DataFrame:
    """Write ``df`` as Parquet under ``shared_path`` and read it back.

    Cuts the lineage with files that every executor reaches, so a lost executor
    costs a re-read and not a re-computation, and the rows stay as first computed.
    """
    spark = df.sparkSession
    path = shared_path(spark, *parts)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

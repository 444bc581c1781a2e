"""Session settings and the shared folder for tables written between stages."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import civicloom

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the operators rely on; all of them can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python's JSON reader keeps the last of two equal keys; so must ours.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Whole pages and texts travel to Python workers: keep an Arrow batch small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession, keep: tuple[str, ...] = ()) -> SparkSession:
    """Apply the settings to a session somebody else made, and let Python workers run the
    package's functions without having it installed.

    The settings hold for everything the session does from then on. ``keep`` names those to leave
    as they are. Right answers need the time zone (for times read from text) and the JSON setting
    (for answers with repeated keys); the others are about speed and memory.
    """
    cloudpickle.register_pickle_by_value(civicloom)
    for key, value in RUNTIME_SETTINGS.items():
        if key not in keep:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir`` or set by
    ``SparkContext.setCheckpointDir``. Without it nothing is written: a folder picked here might
    be one that each machine has to itself."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/civicloom/{context.applicationId}"


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def pin(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame once and go on from the written table.

    Cuts the lineage, so that a lost executor cannot make Spark repeat the work (or give
    another result, where the work is not repeatable), and gives Catalyst the true size:
    it then broadcasts the table only if it is below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    with _dropping_shuffles(spark):
        df.write.parquet(path)
    with _lock:
        _pins.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_pins: dict[str, list[str]] = {}


def pins(spark: SparkSession) -> list[str]:
    """Paths of the tables this application has pinned and not let go, oldest first."""
    with _lock:
        return list(_pins.get(spark.sparkContext.applicationId, []))


def unpin(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete pinned tables that no frame will be read from any more."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        with _lock:
            _pins[spark.sparkContext.applicationId].remove(name)


_writes: dict[str, int] = {}
_asked: dict[str, str | None] = {}
_lock = threading.Lock()


@contextmanager
def _dropping_shuffles(spark: SparkSession):
    """Nobody else reads the shuffles of a pinning write: let their files go with it. The setting
    is the session's, so of writes in several threads the first sets it and the last restores it."""
    session = str(spark._jsparkSession.sessionUUID())
    with _lock:
        _writes[session] = _writes.get(session, 0) + 1
        if _writes[session] == 1:
            _asked[session] = spark.conf.get(_DROP_SHUFFLES, None)
            spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            _writes[session] -= 1
            if _writes[session] == 0:
                asked = _asked.pop(session)
                if asked is None:
                    spark.conf.unset(_DROP_SHUFFLES)
                else:
                    spark.conf.set(_DROP_SHUFFLES, asked)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows out to ``partitions`` tasks before a costly step, for inputs of few files
    that cannot be split; None leaves them as the scan cuts them."""
    return df if partitions is None else df.repartition(partitions)


def tasks_for(spark: SparkSession) -> int:
    """Tasks to deal rows out to before a step that is costly per row: three for each core, so that
    a slow task holds nothing up for long."""
    return 3 * spark.sparkContext.defaultParallelism


def release(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; call it when its frames are no
    longer needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

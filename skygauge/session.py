"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skygauge import files

#: What the library relies on.  Cluster sizing (executors, memory, shuffle
#: partitions, split size) is left to the submitter.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state on local disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_LOCAL_SCRATCH = "skygauge.local.scratch"

#: Scratch whose owner gave no sign for so many seconds belongs to a run that died.
STALE_SECONDS = 7 * 86400
_MARK = "_owner"

#: Folder and step numbers of the run that is under way.
_run: ContextVar[tuple[str, Iterator[int]] | None] = ContextVar("run", default=None)
#: Folders of the steps that the innermost ``settle`` will remove.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def build_session(app_name: str = "skygauge", **extra: str) -> SparkSession:
    """Return a session with the library's settings; ``extra`` overrides them.

    Keyword names use ``__`` for the dots of a Spark setting.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, setting in SESSION_SETTINGS.items():
        builder = builder.config(key, setting)
    for key, setting in extra.items():
        builder = builder.config(key.replace("__", "."), setting)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where one machine holds
    the driver and every executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that every executor can reach"
        )
    local = spark.conf.get(_LOCAL_SCRATCH, None)
    if not local:
        local = tempfile.mkdtemp(prefix="skygauge-")
        spark.conf.set(_LOCAL_SCRATCH, local)
    return local


@dataclass(frozen=True)
class Stored:
    """A stored intermediate table and what was measured while writing it."""

    table: DataFrame
    rows: int
    measures: dict[str, int]
    path: str = ""

    def release(self) -> None:
        """Remove the table.  Whatever reads it must have ended."""
        if self.path:
            files.remove(self.table.sparkSession, self.path)


def materialize(df: DataFrame, label: str, **measures: Column) -> Stored:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The stored copy survives lost executors and fixes values that a recomputation
    could change.  Rows and any further ``measures`` (aggregate columns) are
    observed by the write itself.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation(label)
    named = [column.alias(name) for name, column in measures.items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *named).write.mode("overwrite").parquet(path)
    found = dict(seen.get)
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    return Stored(spark.read.schema(df.schema).parquet(path), found.pop("rows"), found, path)


def settle(build: Callable[[], DataFrame], label: str, **measures: Column) -> Stored:
    """Store what ``build`` returns, and remove the steps that were stored on the way to it."""
    outer, steps = _passing.get(), []
    token = _passing.set(steps)
    try:
        df = build()
        _passing.set(outer)
        spark = df.sparkSession
        done = materialize(df, label, **measures)
    finally:
        _passing.reset(token)
    for path in steps:
        files.remove(spark, path)
    # Spark drops the shuffle files of what nobody refers to when the driver collects garbage.
    del df
    spark.sparkContext._jvm.System.gc()
    return done


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder: the run's own (see ``scratch_of``), else the session's."""
    run = _run.get()
    if run is not None:
        folder, numbers = run
        return f"{folder}/{next(numbers)}-{label}"
    return f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _top(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/skygauge"


_sessions: dict[str, str] = {}


def _session_folder(spark: SparkSession) -> str:
    """Folder of the steps that no run owns; removed when the interpreter ends."""
    application, top = spark.sparkContext.applicationId, _top(spark)
    folder = f"{top}/sessions/{application}"
    if _sessions.get(application) != folder:
        _claim(spark, folder)
        atexit.register(_forget, spark, folder)
        _sessions[application] = folder
    return folder


def _forget(spark: SparkSession, folder: str) -> None:
    # The session may have ended before; then the next one finds the folder stale.
    with suppress(Exception):
        if spark.sparkContext._jsc and not spark.sparkContext._jsc.sc().isStopped():
            files.remove(spark, folder)


def _claim(spark: SparkSession, folder: str) -> None:
    """Mark a folder as owned, and remove those beside it whose owner died long ago."""
    parent = folder.rpartition("/")[0]
    for other in files.entries(spark, parent):
        mark = [e for e in files.entries(spark, other.path) if e.name == _MARK] if other.folder else []
        if time.time() - max([other.changed, *(m.changed for m in mark)]) > STALE_SECONDS:
            files.remove(spark, other.path)
    files.write_text(spark, f"{folder}/{_MARK}", spark.sparkContext.applicationId)


@contextmanager
def scratch_of(spark: SparkSession, job: str) -> Iterator[str]:
    """A folder for the intermediate tables of one run of a job, removed at its end.

    Runs of one job that overlap have a folder each.  What the job computes must be
    written before the block ends.  A run that dies leaves its folder to a later run of
    the job, which removes it after ``STALE_SECONDS``.
    """
    folder = f"{_top(spark)}/{job}/{uuid.uuid4().hex}"
    _claim(spark, folder)
    token = _run.set((folder, count()))
    try:
        yield folder
    finally:
        _run.reset(token)
        files.remove(spark, folder)

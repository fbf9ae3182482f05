"""Session factory and session-scoped helpers.

Library functions never build a session themselves: they take the caller's
``spark`` as an argument, so a driver or orchestrator that already owns a
session (and its cluster config) is never overridden.  ``get_session`` is only
for scripts, tests and the bench.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession


def get_session(
    app_name: str = "strata",
    *,
    master: str | None = None,
    aqe: bool = True,
    shuffle_partitions: int | None = None,
    driver_memory: str = "8g",
    event_log_dir: str | None = None,
    warehouse_dir: str | None = None,
) -> SparkSession:
    """Build (or return the active) session with the settings every run shares.

    * UTC session time zone, so ``timestamp`` columns print the same everywhere.
    * AQE on by default (coalesce + skew-join split); benches turn it off to
      make skew visible, one variable at a time.
    * No UI server.  Stage and task timings come from the event log, written to
      ``event_log_dir`` when given.
    * ``master`` is only applied when no session is active.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", str(aqe).lower())
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", event_log_dir
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextlib.contextmanager
def conf_override(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set runtime SQL confs for a block and restore the previous values (A2).

    Conf keys contain dots, so pass them as ``**{"spark.sql.x": v}``.
    """
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Files a task of a partitioned write keeps open side by side; rows of partitions beyond them are sorted, as Spark does by default.
OPEN_FILES = 100
_WRITING: dict[SparkSession, tuple[int, str | None]] = {}  # writes under way, and the setting before the first of them
_WRITING_LOCK = threading.Lock()


@contextlib.contextmanager
def unsorted_write(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes in the block send each row to its partition's open file instead of sorting the task's rows first.

    The sort holds a task's rows decoded, many times their size in files, and spills what does not fit.
    Writes may overlap (threads): the setting from before is back when the last has ended.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    with _WRITING_LOCK:
        n, before = _WRITING.get(spark, (0, spark.conf.get(key, None)))
        if not n:
            spark.conf.set(key, str(OPEN_FILES))
        _WRITING[spark] = (n + 1, before)
    try:
        yield
    finally:
        with _WRITING_LOCK:
            n, before = _WRITING.pop(spark)
            if n > 1:
                _WRITING[spark] = (n - 1, before)
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


#: Runtime settings under which counts come from Parquet footers (aggregate pushdown).
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
#: What opening a file costs, in bytes read, where its footer is all that is read: a task opens many.
FOOTER_COST = 128 * 1024


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own, where the Parquet source answers counts grouped by all folder columns from footers."""
    session = spark.newSession()
    for key, value in FOOTERS.items():
        session.conf.set(key, value)
    return session


@contextlib.contextmanager
def job_description(spark: SparkSession, text: str) -> Iterator[None]:
    """Label every job started in the block (A6), then clear the label."""
    sc = spark.sparkContext
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setJobDescription(None)  # type: ignore[arg-type]


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables this library writes, which every executor must see.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  A local
    session without it (tests) gets a private temp folder; on a cluster that would
    be some machine's own disk, so there a missing setting is an error.
    """
    d = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")

"""Spark session settings shared by jobs, tests and the bench.

Everything here is plain Spark configuration: UTC session time, ANSI left on
(so the library uses ``try_*`` functions), AQE with partition coalescing and
skew-join splitting, and a bounded broadcast threshold.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. They are safe to set on an
# existing session (the driver hands us one) and cheap to re-apply.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension-sized sides are broadcast only below this measured size;
    # AQE re-checks it against real shuffle statistics at runtime.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_CONFIGURED: set[int] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library assumes (once per session)."""
    key = id(spark)
    if key in _CONFIGURED and spark.conf.get("spark.sql.session.timeZone") == "UTC":
        return spark
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    _CONFIGURED.add(key)
    return spark


def build_session(
    app: str = "swipeflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` defaults to ``$SPARK_MASTER`` or ``local[*]``; on a cluster the
    launcher normally sets it and this argument stays ``None``.
    """
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("SWIPEFLOW_DRIVER_MEMORY", "16g"),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        # no per-call Python call-site capture (several JVM round trips per
        # Column call while building a plan); error messages lose the line
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    conf.update(RUNTIME_CONF)
    # a cluster's own setting stands; only a local session gets a small default
    if shuffle_partitions or (master or "").startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the operator (a shared file
    system); we never invent a machine-local one there. Only a local-mode
    session without the setting (tests, bench) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="swipeflow-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder and read
    it back (reliable ``checkpoint``; survives executor loss, unlike a local
    checkpoint). Used where one job reads the same intermediate several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the jobs run inside go as soon as each has ended, not when the driver collects its garbage. For jobs whose
    result is stored: a frame that is run again would write them anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged writes."""
    base = ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()

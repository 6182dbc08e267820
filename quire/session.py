"""SparkSession construction and the shared work folder.

Production jobs receive the cluster's session; ``get_session`` is for local runs, tests
and the benchmark.  ``work_path`` places intermediate tables in the shared folder named by
``spark.checkpoint.dir`` so they survive executor loss; a local temporary folder is set
only when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the engine relies on.  AQE re-plans joins and partition counts from
# runtime statistics and splits skewed shuffle partitions; the UI stays off.  Static
# (plan-time) auto-broadcast is off: file-size estimates under-count generated rows, so a
# side is broadcast either behind an explicit bounded count or by AQE from the measured
# size of a finished shuffle stage.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # joins on (word, book_id) reuse a book_id bucketing / partitioning of the index
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # an index bucket is one file sorted by (word, book_id): joins can use that order
    # instead of sorting the bucket again (Spark applies it only to one-file buckets)
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings without which joins with the stored, bucketed tables move and sort those tables
BUCKET_CONF = {k: DEFAULT_CONF[k] for k in ("spark.sql.requireAllClusterKeysForCoPartition",
                                            "spark.sql.legacy.bucketedTableScan.outputOrdering")}


def rely_on_buckets(spark: SparkSession) -> None:
    """Put BUCKET_CONF into a session that was not made by :func:`get_session`; results do not depend on it."""
    for key, value in BUCKET_CONF.items():
        spark.conf.set(key, value)


#: source bytes that one task of a sorting scan reads, at most
SORTED_SPLIT = 32 << 20


@contextmanager
def _settings(spark: SparkSession, conf: dict):
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def released_shuffles(spark: SparkSession):
    """Writes started in here have their shuffle files removed as soon as they end.

    For tables that are stored and then read from the shared folder: what was exchanged to make them is read
    by nobody, and would stay on the executors' disks until the driver collects garbage."""
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def sorted_scans(spark: SparkSession):
    """Scans started in here have splits of ``SORTED_SPLIT`` at most, so that a task that sorts what it makes of its
    split does so in its memory: postings of a text take some ten times its stored bytes."""
    key = "spark.sql.files.maxPartitionBytes"
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return _settings(spark, {key: str(min(now, SORTED_SPLIT))})


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quire", conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        settings["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` or a directory set on the context);
    only when neither is set, as in tests, a fresh local folder is created and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        jsc = spark.sparkContext._jsc.sc()
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        jsc = None
    if not root and jsc is not None:
        jdir = jsc.getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    # make sure DataFrame.checkpoint() writes to the same shared folder
    if jsc is not None and not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}quire/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")

"""Size-checked broadcast.

A side is broadcast only after a bounded count proves it has at most ``max_rows`` rows
(``limit(max_rows + 1).count()`` stops early on big inputs).  Otherwise the plan is left
to a shuffle join, and AQE can still switch to a broadcast from runtime statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a broadcast side: query-word tables and small dimension lists.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


#: stored bytes of postings or texts that one task sorts after an exchange; tasks that the sizes alone may ask for
DEAL_BYTES, DEAL_TASKS = 8 << 20, 20_000
#: Spark's size of rows that are not in files is above this
UNKNOWN_BYTES = 1 << 60

KNOWN_SMALL = None   # pass as max_rows when the caller built the data on the driver


def has_at_most(df: DataFrame, max_rows: int | None) -> bool:
    """Bounded count; ``KNOWN_SMALL`` (None) means the caller already knows the bound
    (e.g. a request literal built on the driver) and no job runs."""
    if max_rows is KNOWN_SMALL:
        return True
    return df.limit(max_rows + 1).count() <= max_rows


def collect_if_small(df: DataFrame, max_rows: int) -> list | None:
    """The rows of ``df`` when it has at most ``max_rows`` rows, else None — one job,
    and never more than ``max_rows + 1`` rows reach the driver."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def broadcast_if_small(df: DataFrame,
                       max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _cores(df: DataFrame) -> int | None:
    try:
        return int(df.sparkSession.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        return None


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``partitions`` tasks when its source tables are smaller than
    one full split a core, so CPU-heavy per-row work (tokenizing, regex parsing) runs in
    parallel.  Keyless, so no id or text can make one task hot.  A source of at least one
    full split (``spark.sql.files.maxPartitionBytes``) a core, the normal case at scale, is
    left as it is: no data moves.  The size is the plan's own estimate; no job runs."""
    target = _partitions(df, partitions)
    cores = _cores(df) or target
    if (_source_splits(df) or 0) >= min(cores, target):
        return df
    return df.repartition(target)


def _source_bytes(df: DataFrame) -> int | None:
    """Bytes of the source tables, by the sizes in the optimized plan; None if the plan knows no size."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    except AttributeError:        # a session without a driver JVM
        return None
    # str(): Spark's BigInt comes as a Python int or as an object of the JVM
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < UNKNOWN_BYTES else None


def _source_splits(df: DataFrame) -> int | None:
    """Full splits in the source tables; None if their size is not known."""
    size = _source_bytes(df)
    return None if size is None else size // df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def deal(df: DataFrame, *keys: str, like: DataFrame | None = None) -> DataFrame:
    """``df`` exchanged by ``keys`` for tasks that sort their rows: over the shuffle partitions, or over more if the
    source tables of ``like`` (``df`` itself) have more than ``DEAL_BYTES`` for each, so that a task's rows stay in
    its memory.  Tables dealt alike are joined without another exchange.  The number is given, as adaptive execution
    would unite tasks by their compressed bytes, a small part of what they sort.  No job runs."""
    tasks = min((_source_bytes(df if like is None else like) or 0) // DEAL_BYTES, DEAL_TASKS)
    return df.repartition(max(tasks, _partitions(df, None)), *keys)

"""Claims on frontier pages: a page is handed to one taker, and again when its lease has ended.

The claims are a log of versions (see quire.sinks.commit_log).  A version is a Parquet folder of rows
(page, taker, until, done) and an entry that names it; the last row of a page is its state.  A taker
reads version n, writes its rows, and appends entry n + 1; if another was faster, it starts over
from that one's version.  Rows without an entry, from a taker that crashed or lost, are never read.
Times are seconds since the epoch, given by the caller or taken from the clock.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sinks.commit_log import append_entry, read_entries

CLAIMS_SCHEMA = "page INT, taker STRING, until DOUBLE, done BOOLEAN"
SNAPSHOT_EVERY = 20   # a version holds the whole state at least this often


def _snapshot(spark: SparkSession, path: str) -> tuple[int, int, DataFrame]:
    """(last version, versions since the last whole state, state: one row a page)."""
    entries = read_entries(spark, f"{path}/log")
    start = max((i for i, (_, e) in enumerate(entries) if e["whole"]), default=0)
    live = entries[start:]
    state = spark.createDataFrame([], CLAIMS_SCHEMA + ", version BIGINT")
    for number, entry in live:
        rows = spark.read.schema(CLAIMS_SCHEMA).parquet(f"{path}/data/{entry['folder']}")
        state = state.unionByName(rows.withColumn("version", F.lit(number).cast("bigint")))
    last = state.groupBy("page").agg(F.max_by(F.struct("taker", "until", "done"), "version").alias("c"))
    return (entries[-1][0] if entries else 0), len(live), last.select("page", "c.*")


def claim_state(spark: SparkSession, path: str) -> DataFrame:
    """(page, taker, until, done): the last word on every page that was ever claimed."""
    return _snapshot(spark, path)[2]


def with_claims(front: DataFrame, state: DataFrame, now: float) -> DataFrame:
    """(page, claimed) of a frontier: claimed are finished pages and those under a lease."""
    taken = state.filter(F.col("done") | (F.col("until") > now)).select("page", F.lit(True).alias("taken"))
    return front.select("page", F.col("claimed").alias("given")).join(taken, "page", "left").select(
        "page", (F.col("given") | F.coalesce("taken", F.lit(False))).alias("claimed"))


def _append(spark: SparkSession, path: str, rows_of) -> DataFrame:
    """Commit the rows that ``rows_of(state)`` chooses; starts over when another writer was faster."""
    while True:
        number, versions, state = _snapshot(spark, path)
        folder = "c-" + uuid.uuid4().hex
        place = f"{path}/data/{folder}"
        rows_of(state).select("page", "taker", "until", "done").coalesce(1).write.parquet(place)
        chosen = spark.read.schema(CLAIMS_SCHEMA).parquet(place)
        if chosen.isEmpty():
            return chosen
        whole = versions >= SNAPSHOT_EVERY
        if whole:   # the same rows on top of all others, so that readers need no earlier version
            rest = state.join(chosen.select("page"), "page", "left_anti")
            folder = "s-" + uuid.uuid4().hex
            rest.unionByName(chosen).write.parquet(f"{path}/data/{folder}")
        if append_entry(spark, f"{path}/log", number + 1, {"folder": folder, "whole": whole}):
            return chosen


def claim_pages(front: DataFrame, path: str, taker: str, n: int, lease: float,
                processed: DataFrame | None = None, now: float | None = None) -> DataFrame:
    """(page, taker, until, done): the pages handed to ``taker``, the ``n`` smallest free ones, for
    ``lease`` seconds.  Free is what is not claimed in ``front``, not finished, under nobody's lease and
    not in ``processed``.  No two takers get one page at a time; no free page gives no row.  A null
    page is never handed out, and a page listed twice is one page."""
    spark = front.sparkSession

    def choose(state: DataFrame) -> DataFrame:
        at = time.time() if now is None else now
        free = with_claims(front, state, at).filter(~F.col("claimed") & F.col("page").isNotNull())
        if processed is not None:
            free = free.join(processed.select("page"), "page", "left_anti")
        return free.select("page").distinct().orderBy("page").limit(n).select(
            F.col("page").cast("int"), F.lit(taker).alias("taker"), F.lit(float(at + lease)).alias("until"),
            F.lit(False).alias("done"))

    return _append(spark, path, choose)


def finish_pages(pages: DataFrame, path: str, taker: str, now: float | None = None) -> DataFrame:
    """Mark the pages as fetched by ``taker``; returns those that were.  A page whose lease has ended
    or that another taker holds is left alone."""
    def choose(state: DataFrame) -> DataFrame:
        at = time.time() if now is None else now
        mine = state.filter((F.col("taker") == taker) & ~F.col("done") & (F.col("until") > at))
        return mine.join(pages.select("page"), "page", "left_semi").withColumn("done", F.lit(True))

    return _append(pages.sparkSession, path, choose)

"""What was exchanged to store a table does not stay on the executors' disks once the table is written."""

import os
import time

from quire.plans.indexing import build_index
from quire.session import released_shuffles, work_path
from quire.sinks.index_store import open_index_table, save_index_table, write_run
from support import rows

BOOKS = [(i, f"whale sea{i} whale") for i in range(40)]
KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def _left_of(spark, job):
    """Shuffle files of ``job`` that are still there; they are removed in the background."""
    before = _shuffle_files(spark)
    job()
    for _ in range(100):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_saving_an_index_leaves_no_shuffle_files(spark):
    path, run = work_path(spark, "rl-index"), work_path(spark, "rl-run")
    postings = build_index(spark.createDataFrame(BOOKS, "book_id BIGINT, text STRING"))
    assert not _left_of(spark, lambda: save_index_table(postings, path, 4))
    dealt = postings.repartition(3, "book_id")
    assert not _left_of(spark, lambda: write_run(dealt, run, "r"))
    assert rows(dealt) == rows(open_index_table(spark, path).postings) == rows(spark.read.parquet(f"{run}/run=r"))


def test_the_session_is_as_before(spark):
    before = spark.conf.get(KEY, None)
    for value in ("false", "true"):
        spark.conf.set(KEY, value)
        with released_shuffles(spark):
            assert spark.conf.get(KEY) == "true"
        assert spark.conf.get(KEY) == value
    spark.conf.unset(KEY)
    assert spark.conf.get(KEY, None) == before

"""Merged postings move once, as they are: nothing is exploded, grouped or sorted before their exchange."""

import re

from quire.operators import sizing
from quire.operators.postings import POSTINGS_SCHEMA, merge_postings
from quire.plans.indexing import build_index
from quire.session import work_path
from support import rows

A = [("w", 1, [1, 3]), ("w", 2, [4]), ("v", 2, []), ("u", 2, None), (None, 2, [7]), ("w", None, [9, 2]), ("x", 5, [None, 6])]
B = [("w", 1, [2, 3]), ("w", 2, [4]), ("w", 1, [1]), (None, 2, [7, 8]), ("w", None, [2]), ("y", 5, [None])]
MERGED = [("w", 1, [1, 2, 3]), ("w", 2, [4]), (None, 2, [7, 8]), ("w", None, [2, 9]), ("x", 5, [6]), ("y", 5, [])]


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_merge_is_one_exchange_of_whole_rows(spark):
    a, b = [spark.createDataFrame(r, POSTINGS_SCHEMA).cache() for r in (A, B)]
    merged = merge_postings(a, b)
    assert rows(merged) == sorted(MERGED, key=repr)
    plan = _final_plan(merged)
    above, *below = re.split(r"Exchange hashpartitioning\(book_id", plan)
    assert len(below) == 1 and "Aggregate" in above
    assert not re.search(r"Aggregate|Generate|Sort ", below[0].split("InMemoryTableScan")[0])
    a.unpersist(), b.unpersist()


def test_tasks_of_the_merge_follow_the_tables(spark, monkeypatch):
    path = work_path(spark, "mm-part")
    spark.createDataFrame([(f"w{i}", i, [i]) for i in range(3000)], POSTINGS_SCHEMA).write.parquet(path)
    part = spark.read.parquet(path)
    assert merge_postings(part, part).rdd.getNumPartitions() == 8
    monkeypatch.setattr(sizing, "DEAL_BYTES", 1000)
    wide = merge_postings(part, part)
    assert wide.rdd.getNumPartitions() > 8
    assert rows(wide) == rows(part)
    monkeypatch.setattr(sizing, "DEAL_TASKS", 3)
    assert merge_postings(part, part).rdd.getNumPartitions() == 8


def test_tables_of_a_full_split_a_core_are_not_spread(spark):
    path, key = work_path(spark, "mm-books"), "spark.sql.files.maxPartitionBytes"
    spark.createDataFrame([(i, f"whale sea{i} whale") for i in range(300)], "book_id BIGINT, text STRING").write.parquet(path)
    books = spark.read.parquet(path)
    small = build_index(books)
    assert "RoundRobinPartitioning" in _final_plan(small)
    before = spark.conf.get(key, None)
    spark.conf.set(key, "100")
    try:
        assert "RoundRobinPartitioning" not in _final_plan(build_index(books))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)

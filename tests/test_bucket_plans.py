"""Stored tables stay where they are, also in a session that lacks the engine's settings."""

import re

from quire.operators import search as S
from quire.operators.word_blocks import word_blocks
from quire.plans.indexing import build_index
from quire.session import BUCKET_CONF, work_path
from quire.sinks.index_store import open_index_table, save_index_table
from support import rows

TEXTS = [(i, "whale sea ship whale") for i in range(600)]


def test_positions_join_inside_the_buckets_of_a_plain_session(spark):
    path = work_path(spark, "bp-index")
    save_index_table(build_index(spark.createDataFrame(TEXTS, "book_id BIGINT, text STRING")), path, 4)
    for key in BUCKET_CONF:
        spark.conf.unset(key)
    try:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
        index = open_index_table(spark, path)
        keys = spark.createDataFrame([("whale", 5), ("sea", 8), ("none", 1)], "word STRING, book_id BIGINT")
        got = S.positions_in_book(index, keys)
        assert rows(got) == [("sea", 8, [1]), ("whale", 5, [0, 3])]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Exchange hashpartitioning\(book_id#\d+L, 4\)", plan), plan
        assert not re.search(r"Exchange hashpartitioning\(word#\d+, book_id#\d+L, 4\)", plan), plan
    finally:
        for key, value in BUCKET_CONF.items():
            spark.conf.set(key, value)


def test_bitmaps_dealt_first_are_the_same_in_one_exchange(spark):
    postings = build_index(spark.createDataFrame(TEXTS, "book_id BIGINT, text STRING")).cache()
    dealt = word_blocks(postings, 2, 4)
    assert rows(dealt) == rows(word_blocks(postings, 2))
    plan = dealt._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1
    postings.unpersist()

"""Postings made row by row: books of one row are under no exchange, repeated ids are still united."""

from quire.operators.postings import build_postings
from quire.operators.tokens import index_tokens
from quire.plans.indexing import build_index
from support import rows

SCHEMA = "book_id BIGINT, text STRING"


def _by_tokens(books):
    return build_postings(index_tokens(books))


def test_books_of_one_row_are_not_shuffled(spark):
    books = spark.createDataFrame([(i, f"whale sea{i} whale") for i in range(6)], SCHEMA)
    built = build_index(books, partitions=2)
    assert ("whale", 3, [0, 2]) in rows(built)
    built.collect()
    final = built._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "hashpartitioning" not in final


def test_repeated_null_and_empty_books(spark):
    books = spark.createDataFrame([
        (1, "the whale, a Whale"), (2, "sea"), (2, "sea sea whale"), (2, "sea"), (3, None), (4, ""), (5, "the of"),
        (None, "ship"), (None, "a ship sails"), (6, "ship  ship\nsea")], SCHEMA)
    assert rows(build_index(books)) == rows(_by_tokens(books))
    assert rows(build_index(books, max_broadcast_rows=1)) == rows(_by_tokens(books))
    one_null = spark.createDataFrame([(None, "ship sea"), (1, "sea")], SCHEMA)
    assert rows(build_index(one_null)) == rows(_by_tokens(one_null))

import json
import os
import tempfile

from pyspark.sql import functions as F

from support import rows
from quire.session import work_path
from quire.sinks.books_store import latest_books, read_books, store_books
from quire.sinks.results import result_json, write_results_json
from quire.sources.stopwords import stopwords_frame


def test_result_json_and_writer(spark):
    df = spark.createDataFrame([(1, 7, {"sea": [3, 9], "ahab": [1]})],
                               "query_id BIGINT, book_id BIGINT, positions MAP<STRING, ARRAY<INT>>")
    obj = json.loads(df.select(result_json().alias("j")).first()["j"])
    assert obj == {"bookId": 7, "positions": {"sea": [3, 9], "ahab": [1]}}
    out = work_path(spark, "t-json")
    write_results_json(df, out)
    back = spark.read.json(out).first()
    assert back["bookId"] == 7 and back["positions"]["sea"] == [3, 9]


def test_stopwords_from_file_trimmed_lowered_distinct(spark):
    d = tempfile.mkdtemp(prefix="quire-sw-")
    path = os.path.join(d, "stop.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("The\n  and \nthe\nOF\n")
    assert sorted(r.word for r in stopwords_frame(spark, path).collect()) == ["and", "of", "the"]
    assert stopwords_frame(spark).count() == 176


def test_store_keeps_last_arrival(spark):
    books = spark.createDataFrame([
        (1, "1", "old", 1), (1, "001", "newer", 2), (2, "2", "only", 1)],
        "book_id BIGINT, doc_key STRING, text STRING, arrival INT")
    assert rows(latest_books(books)) == [(1, "001", "newer"), (2, "2", "only")]
    path = work_path(spark, "t-store")
    store_books(books, path)
    again = books.filter(F.col("book_id") == 2).withColumn("text", F.lit("later"))
    store_books(again, path)                       # replaces book 2 and leaves book 1
    assert rows(read_books(spark, path), "book_id", "text") == [(1, "newer"), (2, "later")]
    assert rows(latest_books(books.withColumn("arrival", F.lit(1))), "book_id", "text") == [
        (1, "old"), (2, "only")]                   # a tie goes to the greater key


def test_bucket_count_is_stored_with_the_table(spark):
    import pytest
    from quire.sinks.index_store import (
        open_catalog_table, open_index_table, save_catalog_table, save_index_table,
    )
    postings = spark.range(60).selectExpr("'w' AS word", "id AS book_id", "array(1) AS positions")
    catalog = spark.range(60).selectExpr("id AS book_id", "'t' AS title", "'a' AS author",
                                         "'May 1, 1999' AS date", "'English' AS language")
    idx, cat = work_path(spark, "t-idx"), work_path(spark, "t-cat")
    with pytest.raises(ValueError):
        open_index_table(spark, idx)
    save_index_table(postings, idx, 8)
    save_catalog_table(catalog, cat, 16)
    assert open_index_table(spark, idx).postings.filter("book_id >= 0").count() == 60
    assert open_catalog_table(spark, cat).filter("year = 1999").count() == 60
    for opened, path, wrong in ((open_index_table, idx, 4), (open_catalog_table, cat, 8)):
        with pytest.raises(ValueError):
            opened(spark, path, wrong)
    tables = len(spark.catalog.listTables())
    open_index_table(spark, idx)
    assert len(spark.catalog.listTables()) == tables
    save_index_table(postings.filter("book_id < 10"), idx, 4)      # a new version, other buckets
    again = open_index_table(spark, idx)
    assert again.postings.count() == 10 and again.words.first()["n_books"] == 10


def test_books_of_two_runs_are_merged_and_empty_runs_are_read(spark):
    from quire.operators import search as S
    from quire.plans.indexing import build_index, index_new_books
    from quire.sinks.index_store import append_ledger, read_ledger, read_postings, write_run
    books = spark.createDataFrame([("1", 1, "blue whale sea"), ("2", 2, "green sea")],
                                  "doc_key STRING, book_id BIGINT, text STRING")
    idx, led = work_path(spark, "t-runs"), work_path(spark, "t-led")
    index_new_books(books.filter("false"), idx, led)
    assert read_postings(spark, idx, led).count() == 0
    for run in ("a", "b"):                         # two jobs that did not see each other
        write_run(build_index(books), idx, run)
        append_ledger(books, led, run)
    merged = read_postings(spark, idx, led)
    assert rows(merged) == rows(build_index(books))
    assert [r.book_id for r in S.search(spark, merged, ["whale", "sea"]).collect()] == [1]
    assert S.search(spark, merged, ["whale", "absent"]).count() == 0
    assert read_ledger(spark, led).count() == 4


def test_folder_left_by_a_failed_write_reads_as_empty(spark):
    from quire.sinks.index_store import read_ledger, read_postings
    path = work_path(spark, "t-left")
    os.makedirs(path + "/_temporary/0")
    assert read_ledger(spark, path).count() == 0
    assert read_postings(spark, path, path).count() == 0


def test_stored_texts_are_not_exchanged_and_ties_go_to_the_later_place(spark):
    path = work_path(spark, "t-places")
    schema = "book_id BIGINT, doc_key STRING, text STRING, arrival INT"
    for arrival in (1, 2):
        batch = spark.createDataFrame([(b, str(b), f"text {b} of {arrival}", arrival) for b in range(40 // arrival)] +
                                      [(None, "x", f"nameless {arrival}", arrival)], schema)
        store_books(batch, path)
    stored = read_books(spark, path)
    assert rows(stored) == sorted([(b, str(b), f"text {b} of {2 if b < 20 else 1}") for b in range(40)] +
                                  [(None, "x", "nameless 2")], key=repr)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert not moved, moved
    twice = work_path(spark, "t-twice")
    spark.createDataFrame([(1, "1", "b", 1), (1, "1", "a", 1)], schema).coalesce(1).write.parquet(twice)
    assert rows(latest_books(spark.read.schema(schema).parquet(twice)), "text") == [("a",)]


def test_two_stores_at_once_get_batches_of_their_own(spark):
    from quire.sinks.books_store import _claim_batch
    path = work_path(spark, "t-claims")
    assert [_claim_batch(spark, path) for _ in range(3)] == [1, 2, 3]
    books = spark.createDataFrame([(1, "1", "first", 1)], "book_id BIGINT, doc_key STRING, text STRING, arrival INT")
    store_books(books, path)
    store_books(books.withColumn("text", F.lit("second")), path)
    assert rows(read_books(spark, path)) == [(1, "1", "second")]

"""A batch search moves the rows of its answer once, and equal requests in shares."""

import re

from quire.operators import search as S
from quire.operators.catalog import load_catalog
from quire.plans import fixtures
from quire.plans.indexing import build_index
from quire.session import work_path
from quire.sinks.index_store import open_catalog_table, open_index_table, save_catalog_table, save_index_table
from quire.sources.books import books_from_table

SF = "/root/testdata/sf0.001"
BOOKS = [(1, "whale sea"), (2, "sea whale whale"), (3, "sea"), (4, "whale sea ship"), (300, "sea whale")]


def test_rows_of_the_answer_are_under_one_exchange(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    idx, cat = work_path(spark, "mv-index"), work_path(spark, "mv-cat")
    save_index_table(build_index(books_from_table(docs)), idx, 8)
    save_catalog_table(load_catalog(fixtures.catalog_lines(docs)), cat, 8)
    df = S.search_batch(open_index_table(spark, idx), fixtures.title_requests(docs), open_catalog_table(spark, cat))
    exchanges = re.findall(r"Exchange hashpartitioning\((.*)\), ", df._jdf.queryExecution().executedPlan().toString())
    # from the top: the first exchange deals matches to the buckets of the index, all others are below the bitmaps
    assert exchanges and "book_id" in exchanges[0]
    assert [e for e in exchanges if "book_id" in e] == exchanges[:1]


def test_many_equal_requests_are_answered_in_shares(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARE", 4)
    index = build_index(spark.createDataFrame(BOOKS, "book_id BIGINT, text STRING"))
    requests = S.make_requests(spark, [{"query_id": i, "words": ["sea", "whale"]} for i in range(30)] + [{"query_id": 30, "words": ["ship"]}])
    seen, attach = [], S.attach_positions

    def kept(postings, matches, requests):
        seen.extend(len(r.ids) for r in matches.collect())
        return attach(postings, matches, requests)

    monkeypatch.setattr(S, "attach_positions", kept)
    got = S.search_batch(index, requests).collect()
    assert sorted((r.query_id, r.book_id) for r in got) == [(q, b) for q in range(30) for b in (1, 2, 4, 300)] + [(30, 4)]
    assert sum(seen) == 30 * 4 + 1 and max(seen) < 30
    assert {tuple(sorted(r.positions)) for r in got} == {("sea", "whale"), ("ship",)}

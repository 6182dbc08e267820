"""Requests of the same words and criteria are answered once and dealt to all who asked."""

from pyspark.sql import functions as F

from quire.operators import search as S
from quire.plans.indexing import build_index
from support import rows

BOOKS = [(1, "whale sea"), (2, "sea whale whale"), (3, "sea"), (4, "whale sea ship"), (300, "sea whale")]


def _requests(spark):
    same = [{"query_id": i, "words": ["sea", "whale"] if i % 2 else ["whale", "sea", "sea"]} for i in range(40)]
    other = [{"query_id": 50, "words": ["sea", "whale"], "author": "ann"}, {"query_id": 51, "words": ["sea", "whale"], "author": "bob"},
             {"query_id": 52, "words": ["sea", "whale"], "author": "ann"}, {"query_id": 53, "words": ["ship"]},
             {"query_id": 54, "words": ["sea", "unknown"]}, {"query_id": 55, "words": []}]
    return S.make_requests(spark, same + other)


def test_equal_requests_move_their_matches_once(spark, monkeypatch):
    index = build_index(spark.createDataFrame(BOOKS, "book_id BIGINT, text STRING"))
    catalog = spark.createDataFrame([(1, "t", "Ann", "2001", "English"), (2, "t", "Bob", "2001", "English"), (4, "t", "Ann", None, None)],
                                    "book_id BIGINT, title STRING, author STRING, date STRING, language STRING")
    seen, attach = [], S.attach_positions

    def kept(postings, matches, requests):
        seen.append(matches.count())
        return attach(postings, matches, requests)

    monkeypatch.setattr(S, "attach_positions", kept)
    got = S.search_batch(index, _requests(spark), catalog)
    assert seen == [4 + 2 + 1 + 1]      # not 40 times 4
    expect = [(q, b) for q in range(40) for b in (1, 2, 4, 300)]
    expect += [(50, 1), (50, 4), (51, 2), (52, 1), (52, 4), (53, 4)]
    assert sorted((r.query_id, r.book_id) for r in got.collect()) == sorted(expect)
    two = {r.query_id: r.positions for r in got.filter("book_id = 2").collect()}
    assert two[7] == two[8] == {"sea": [0], "whale": [1, 2]}


def test_without_catalogue_criteria_do_not_part_requests(spark):
    index = build_index(spark.createDataFrame(BOOKS, "book_id BIGINT, text STRING"))
    got = S.search_batch(index, _requests(spark).filter(F.col("query_id") >= 50))
    assert rows(got.select("query_id", "book_id")) == sorted(
        [(q, b) for q in (50, 51, 52) for b in (1, 2, 4, 300)] + [(53, 4)], key=repr)

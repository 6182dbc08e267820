"""The matches of one share of equal requests move one after the other, so that they are compressed together."""

from itertools import groupby

from quire.operators import search as S
from quire.plans.indexing import build_index


def test_all_blocks_of_a_share_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARE", 4)
    ids = [n * 300 + i for n in range(6) for i in range(3)]     # six blocks
    index = build_index(spark.createDataFrame([(i, "whale sea") for i in ids], "book_id BIGINT, text STRING"))
    catalog = spark.createDataFrame([(i, "t", "Ann", "2001", "English") for i in ids],
                                    "book_id BIGINT, title STRING, author STRING, date STRING, language STRING")
    seen, filtered = [], S.filter_with_catalog

    def kept(matches, catalog):
        seen.extend(matches.rdd.glom().collect())
        return filtered(matches, catalog)

    monkeypatch.setattr(S, "filter_with_catalog", kept)
    requests = S.make_requests(spark, [{"query_id": i, "words": ["sea", "whale"], "author": "ann"} for i in range(40)])
    got = S.search_batch(index, requests, catalog).collect()
    assert sorted((r.query_id, r.book_id) for r in got) == [(q, b) for q in range(40) for b in ids]
    shares = {tuple(r.ids) for part in seen for r in part}
    runs = sum(len(list(groupby(part, lambda r: tuple(r.ids)))) for part in seen)
    assert len(shares) > 1 and runs == len(shares)
    assert sum(len(part) for part in seen) == len(shares) * len(ids)

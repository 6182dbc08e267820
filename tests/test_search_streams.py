"""A batch search neither sorts nor groups the rows of its answer, which can be far more than the index."""

import re

from quire.operators import search as S
from quire.operators.catalog import load_catalog
from quire.plans import fixtures
from quire.plans.indexing import build_index
from quire.session import work_path
from quire.sinks.index_store import open_catalog_table, open_index_table, save_catalog_table, save_index_table
from quire.sources.books import books_from_table

SF = "/root/testdata/sf0.001"
LONG = "ship anchor whale sea mast"


def test_matches_pass_without_sort_or_aggregate_after_their_exchange(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    idx, cat = work_path(spark, "st-index"), work_path(spark, "st-cat")
    save_index_table(build_index(books_from_table(docs)), idx, 8)
    save_catalog_table(load_catalog(fixtures.catalog_lines(docs)), cat, 8)
    df = S.search_batch(open_index_table(spark, idx), fixtures.title_requests(docs), open_catalog_table(spark, cat))
    for got in (df, df.select("query_id", "book_id")):
        plan = got._jdf.queryExecution().executedPlan().toString()
        top = re.split(r"Exchange hashpartitioning\(book_id", plan)
        assert len(top) == 2
        assert "ShuffledHashJoin" in top[0] and not re.search(r"Sort|Aggregate", top[0])
        # requests are dealt by block, not by word and block, and bitmaps are dealt once, by block
        dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", top[1])
        assert not [e for e in dealt if "word#" in e and "block#" in e]


def test_requests_of_few_and_of_many_words(spark):
    index = build_index(spark.createDataFrame(
        [(1, LONG), (2, f"sea {LONG} sea"), (3, "sea whale"), (700, f"{LONG} rope")], "book_id BIGINT, text STRING"))
    words = LONG.split()
    assert len(words) > S.FEW
    asked = [words[:n] for n in range(1, len(words) + 1)] + [["whale", "sea"], ["rope", *words], ["sea", "none"]]
    got = S.search_batch(index, S.make_requests(spark, [{"query_id": i, "words": w} for i, w in enumerate(asked)])).collect()
    texts = {1: LONG, 2: f"sea {LONG} sea", 3: "sea whale", 700: f"{LONG} rope"}
    expect = {(i, b): {w: [p for p, x in enumerate(t.split()) if x == w] for w in q}
              for i, q in enumerate(asked) for b, t in texts.items() if set(q) <= set(t.split())}
    assert {(r.query_id, r.book_id): r.positions for r in got} == expect and len(got) == len(expect)

import random
import re

from pyspark.sql import functions as F

from support import rows
from quire.functions.text import tokenize
from quire.operators.forward import fragments, fragments_of_hits, token_blocks
from quire.session import work_path
from quire.sinks.forward_store import fragment_at, open_forward_table, save_forward_table


def test_fragments_equal_slices_of_the_tokens(spark):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice("abcdefghijkl") * 2 for _ in range(n)) for i, n in enumerate([1, 3, 4, 5, 16, 41])}
    books = spark.createDataFrame(list(texts.items()), "book_id BIGINT, text STRING")
    places = [(b, p) for b, t in texts.items() for p in range(-2, len(t.split()) + 3)]
    hits = spark.createDataFrame(places, "book_id BIGINT, pos INT")
    for radius in (0, 1, 3, 9):      # blocks of four tokens: fragments of one to six blocks
        expect = sorted((b, p, " ".join(texts[b].split()[max(p - radius, 0):p + radius + 1]))
                        for b, p in places if 0 <= p < len(texts[b].split()))
        got = fragments(token_blocks(books, tokenize, 4), hits, radius, 4)
        assert sorted(map(tuple, got.collect())) == expect


def test_keyword_in_context_edges(spark):
    books = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "book_id BIGINT, text STRING")
    hits = spark.createDataFrame([(1, 0), (1, 6), (1, 11)], "book_id BIGINT, pos INT")
    assert rows(fragments_of_hits(token_blocks(books), hits, 2), "pos", "fragment") == [
        (0, "a b c"), (11, "j k l"), (6, "e f g h i")]


def test_copies_versions_nulls_and_extra_columns(spark):
    books = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "x y"), (2, None), (3, ""), (None, "q"), (4, "!!")],
                                  "book_id BIGINT, text STRING")
    blocks = token_blocks(books).distinct()
    assert rows(blocks, "book_id", "tokens") == [(1, ["a", "b", "c"]), (1, ["x", "y"])]
    hits = spark.createDataFrame([(1, 1, "h", "t"), (1, 1, "h", "t"), (1, 2, "i", None), (2, 0, "j", "t"), (None, 0, "k", "t")],
                                 "book_id BIGINT, pos INT, version STRING, tokens STRING")
    got = fragments_of_hits(blocks, hits, 1)
    assert got.columns == ["book_id", "pos", "version", "tokens", "fragment"]
    # the same hit twice stays twice; two texts under one id answer each for itself
    assert rows(got, "pos", "version", "fragment") == [(1, "h", "a b c")] * 2 + [(1, "h", "x y")] * 2 + [(2, "i", "b c")]
    assert fragments_of_hits(blocks, hits.limit(0)).count() == 0


def test_stored_forward_index_is_not_moved_and_a_literal_place_opens_its_buckets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("book_id"), "text")
    path = work_path(spark, "t-forward")
    save_forward_table(docs.unionByName(docs), path, 8)
    forward = open_forward_table(spark, path)
    assert forward.count() == token_blocks(docs).count()           # copies are stored once
    longest = docs.orderBy(F.desc(F.length("text"))).first()
    words = spark.createDataFrame([longest]).select(tokenize(F.col("text")).alias("t")).first()["t"]
    assert len(words) > 1024
    assert forward.filter(F.col("book_id") == longest["book_id"]).select("cell").distinct().count() == -(-len(words) // 512)
    one = fragment_at(spark, path, longest["book_id"], 1000, 30)
    assert [r["fragment"] for r in one.collect()] == [" ".join(words[970:1031])]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SelectedBucketsCount: [12] out of 8", plan)
    hits = spark.createDataFrame([(longest["book_id"], p) for p in (0, 511, 512, len(words) - 1)], "book_id BIGINT, pos INT")
    plan = fragments_of_hits(forward, hits)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan parquet spark_catalog" in line)
    depth = [len(re.match(r"[\s:+|*()0-9-]*", line)[0]) for line in lines]
    near, d = [], depth[at]
    for i in range(at - 1, -1, -1):                                # the operators above the scan, up to its join
        if depth[i] < d:
            near.append(lines[i])
            d = depth[i]
            if "Join" in lines[i]:
                break
    assert not any("Exchange" in line for line in near) and "split" not in plan

import pytest
from pyspark.sql import functions as F

from support import rows
from quire.functions.text import parse_query
from quire.operators import search as S
from quire.operators.catalog import load_catalog
from quire.plans.indexing import build_index

TEXTS = {
    1: "The white whale swam. The whale dived; the sea was calm.",
    2: "A whale and a ship on the sea.",
    3: "Ship ahoy! The sea, the sea.",
    4: "Nothing relevant in this book at all.",
}
LINES = [
    "ID: 1, Title: Moby Dick, Author: Herman Melville, Release Date: Oct 18, 1851, Language: English",
    "ID: 2, Title: Sea Tales, Author: Anon, Release Date: Unknown, Language: English",
    "ID: 3, Title: Ship Log, Author: Cook, Release Date: Jan 1, 1900, Language: Spanish",
]


@pytest.fixture(scope="module")
def index(spark):
    books = spark.createDataFrame(list(TEXTS.items()), "book_id BIGINT, text STRING")
    return build_index(books).cache()


@pytest.fixture(scope="module")
def catalog(spark):
    lines = spark.createDataFrame(list(enumerate(LINES)), "line_no BIGINT, line STRING")
    return load_catalog(lines)


def ids(df):
    return sorted(r["book_id"] for r in df.collect())


def test_all_words_with_positions(spark, index):
    res = S.search(spark, index, ["whale", "sea"]).collect()
    assert [r.book_id for r in res] == [1, 2]
    assert res[0].positions == {"whale": [2, 5], "sea": [8]}


@pytest.mark.parametrize("words,expected", [
    (["Whale"], []),            # no lower-casing of the request
    (["the", "sea"], []),       # stopwords are not indexed
    (["sea", "sea"], [1, 2, 3]),  # duplicates count once
    ([], []),                   # no words, no books
    (["sea", ""], []),          # an empty word never matches
    (["ship"], [2, 3]),
])
def test_request_semantics(spark, index, words, expected):
    assert ids(S.search(spark, index, words)) == expected


def test_parse_query_like_java_split(spark):
    df = spark.createDataFrame([(q,) for q in ["a+b", "a++b", "a+", "+a", "", "+++"]], "q STRING")
    got = [r[0] for r in df.select(parse_query("q")).collect()]
    assert got == [["a", "b"], ["a", "", "b"], ["a"], ["", "a"], [""], []]


def test_search_is_subset_of_each_single_word_search(spark, index):
    both = set(ids(S.search(spark, index, ["whale", "ship"])))
    assert both <= set(ids(S.search(spark, index, ["whale"])))
    assert both <= set(ids(S.search(spark, index, ["ship"])))
    assert both == {2}


def test_criteria(spark, index, catalog):
    sea = ["sea"]
    assert ids(S.search(spark, index, sea, catalog=catalog)) == [1, 2, 3]
    assert ids(S.search(spark, index, sea, title="MOBY", catalog=catalog)) == [1]
    assert ids(S.search(spark, index, sea, author="co", catalog=catalog)) == [3]
    assert ids(S.search(spark, index, sea, language="engl", catalog=catalog)) == [1, 2]
    # year bounds are inclusive; an "Unknown" date is dropped only when a bound is set
    assert ids(S.search(spark, index, sea, year_from="1851", catalog=catalog)) == [1, 3]
    assert ids(S.search(spark, index, sea, year_to="1851", catalog=catalog)) == [1]
    assert ids(S.search(spark, index, sea, year_from="1852", year_to="1900",
                        catalog=catalog)) == [3]
    # "" matches every book that has the field
    assert ids(S.search(spark, index, sea, title="", catalog=catalog)) == [1, 2, 3]
    with pytest.raises(ValueError):
        S.search(spark, index, sea, year_from="nineteen", catalog=catalog)


def test_book_without_metadata_dropped_only_with_criteria(spark, index, catalog):
    req = S.make_requests(spark, [
        dict(query_id=1, words=["relevant"]),
        dict(query_id=2, words=["relevant"], language="e"),
    ])
    got = rows(S.search_batch(index, req, catalog), "query_id", "book_id")
    assert got == [(1, 4)]


def test_batch_equals_single_requests(spark, index, catalog):
    reqs = [dict(query_id=i, words=w, **c) for i, (w, c) in enumerate([
        (["sea"], {}), (["whale", "sea"], {"year_to": "1900"}), (["ship"], {"title": "log"}),
        (["sea"], {"language": "spanish", "year_from": "1800"})])]
    batch = S.search_batch(index, S.make_requests(spark, reqs), catalog)
    got = {}
    for r in batch.collect():
        got.setdefault(r.query_id, []).append(r.book_id)
    for r in reqs:
        crit = {k: v for k, v in r.items() if k not in ("query_id", "words")}
        single = ids(S.search(spark, index, r["words"], catalog=catalog, **crit))
        assert sorted(got.get(r["query_id"], [])) == single


def test_intersect_matches_division(spark, index):
    req = S.make_requests(spark, [dict(query_id=1, words=["whale", "sea"]),
                                  dict(query_id=2, words=["ship", "sea"])])
    inter = rows(S.intersect_two_words(index, req), "query_id", "book_id")
    div = rows(S.matching_books(index, req), "query_id", "book_id")
    assert inter == div == [(1, 1), (1, 2), (2, 2), (2, 3)]


def test_point_lookups(spark, index):
    words = spark.createDataFrame([("whale",), ("nope",)], "word STRING")
    assert rows(S.books_by_word(index, words)) == [("whale", 1), ("whale", 2)]
    keys = spark.createDataFrame([("sea", 3), ("sea", 4)], "word STRING, book_id BIGINT")
    assert rows(S.positions_in_book(index, keys)) == [("sea", 3, [3, 5])]


def test_division(spark, index):
    req = S.make_requests(spark, [
        dict(query_id=1, words=["whale", "sea"]), dict(query_id=2, words=["sea"]),
        dict(query_id=3, words=["sea", "nothere"]), dict(query_id=4, words=[]),
        dict(query_id=5, words=["ship", "sea", "ship"]), dict(query_id=6, words=["sea", None])])
    assert rows(S.matching_books(index, req), "query_id", "book_id") == [
        (1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (5, 2), (5, 3)]


def test_two_word_requests_only(spark, index):
    with pytest.raises(Exception, match="two words"):
        S.intersect_two_words(index, S.make_requests(spark, [dict(query_id=1, words=["sea"])])).collect()


def test_stored_index_roundtrip(spark, index, catalog):
    from quire.session import work_path
    from quire.sinks.index_store import open_index_table, save_index_table
    path = work_path(spark, "t-index-table")
    save_index_table(index, path, 4)
    stored = open_index_table(spark, path)   # fresh table name, same files
    assert sorted(map(tuple, stored.postings.collect())) == sorted(map(tuple, index.collect()))
    got = S.search(spark, stored, ["whale", "sea"], year_to="1900", catalog=catalog).collect()
    assert [(r.book_id, r.positions) for r in got] == [(1, {"whale": [2, 5], "sea": [8]})]
    reqs = S.make_requests(spark, [
        dict(query_id=1, words=["whale", "sea"]), dict(query_id=2, words=["sea"], title="moby"),
        dict(query_id=3, words=["ship", "sea"], year_from="1800"), dict(query_id=4, words=["x"])])

    def answer(idx):
        res = S.search_batch(idx, reqs, catalog)
        return sorted((r.query_id, r.book_id, tuple(sorted(r.positions.items()))) for r in res.collect())

    # book 2's release date is "Unknown", so the year bound of query 3 drops it
    assert [r[:2] for r in answer(stored)] == [(1, 1), (1, 2), (2, 1), (3, 3)]
    assert answer(stored) == answer(index)


def test_bitmaps_hold_every_book_of_every_word(spark):
    """Ids across blocks, lanes and parts, negative ones too; words in one book and in most."""
    from quire.operators.word_blocks import PART_BLOCKS, books_of, parts_for, word_blocks, word_counts
    ids = [-300, -256, -1, 0, 1, 63, 64, 255, 256, 257, 1000, 70_000, 2 ** 40, 2 ** 40 + 255]
    pairs = [("all", i) for i in ids] + [("one", 64), ("far", 2 ** 40 + 255)] + [(f"w{i % 5}", i) for i in ids]
    df = spark.createDataFrame(pairs + pairs[:7], "word STRING, book_id BIGINT")
    for parts in (1, 3):
        blocks = word_blocks(df, parts)
        assert rows(books_of(blocks, "word")) == sorted(set(pairs), key=repr)
        counts = {w: len({i for x, i in pairs if x == w}) for w, _ in pairs}
        assert {r.word: r.n_books for r in word_counts(blocks).collect()} == counts
        assert {r.part for r in blocks.collect()} <= set(range(parts))
    assert parts_for(0, 255) == 1 and parts_for(0, 256 * PART_BLOCKS) == 2 and parts_for(-1, 0) == 1


def test_search_over_several_parts(spark, index):
    from dataclasses import replace
    from quire.operators.word_blocks import word_blocks
    far = index.unionByName(index.withColumn("book_id", F.col("book_id") + 256 * 5))
    one = S.index_over(far)
    many = replace(one, blocks=word_blocks(far, 3), parts=3)
    req = S.make_requests(spark, [dict(query_id=i, words=w) for i, w in enumerate((["sea"], ["whale", "sea"], ["ship", "sea"]))])
    assert rows(S.matching_books(many, req)) == rows(S.matching_books(one, req)) != []
    assert rows(S.books_by_word(many, req.select(F.explode("words").alias("word")))) == \
        rows(S.books_by_word(one, req.select(F.explode("words").alias("word"))))


def test_word_lookup_opens_few_files_at_any_bucket_count(spark):
    """One word in every book, many rare ones: a rare word is in at most two files, a frequent
    one in the files that its postings fill, a posting of one book in at most two."""
    from quire.session import work_path
    from quire.sinks.index_store import current_version, open_index_table, save_index_table, word_files, word_postings
    common = spark.range(4000).selectExpr("'common' AS word", "id AS book_id", "array(1, 2) AS positions")
    rare = spark.range(8000).selectExpr("concat('w', id) AS word", "id % 4000 AS book_id", "array(3) AS positions")
    for buckets in (4, 32):
        path = work_path(spark, "t-words")
        save_index_table(common.unionByName(rare), path, buckets)
        folder = f"{path}/{current_version(spark, path)['version']}"
        for word in ("w0", "w77", "w7999"):
            assert 1 <= len(word_files(spark, folder, [word])) <= 2
        assert buckets // 4 <= len(word_files(spark, folder, ["common"])) <= buckets // 2 + 2
        assert 1 <= len(word_files(spark, folder, ["common"], 1234)) <= 2
        assert word_files(spark, folder, ["zzz"]) == [] and word_files(spark, folder, [""]) == []
        found = open_index_table(spark, path).find(["w77", "w4077", "absent", "w5"])
        assert rows(found, "word", "book_id") == [("w4077", 77), ("w5", 5), ("w77", 77)]
        assert len(found.inputFiles()) <= 6
        assert rows(word_postings(spark, folder, ["common"], 1234)) == [("common", 1234, [1, 2])]
        assert word_postings(spark, folder, ["common"]).count() == 4000
    assert open_index_table(spark, path).find([]).count() == 0


def test_random_requests_on_real_index_equal_intersections(spark):
    """On the sf0.001 index: a k-word request returns exactly the books in every
    one-word answer (words drawn from the real vocabulary, frequent and rare)."""
    import random
    from quire.sources.books import books_from_table
    idx = build_index(books_from_table(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))).cache()
    vocab = [r.word for r in S.index_over(idx).words.orderBy(F.desc("n_books"), "word").limit(300).collect()]
    rng = random.Random(7)
    reqs = [dict(query_id=i, words=rng.sample(vocab, rng.choice([2, 3]))) for i in range(40)]
    got = {}
    for r in S.search_batch(idx, S.make_requests(spark, reqs)).collect():
        got.setdefault(r.query_id, set()).add(r.book_id)
    books_of = {}
    for r in idx.filter(F.col("word").isin(vocab)).select("word", "book_id").collect():
        books_of.setdefault(r.word, set()).add(r.book_id)
    for q in reqs:
        expect = set.intersection(*(books_of[w] for w in q["words"]))
        assert got.get(q["query_id"], set()) == expect
    idx.unpersist()

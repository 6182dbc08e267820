"""Conjunctive multi-word search over a positional index, with metadata criteria.

A request is a row ``(query_id, words ARRAY<STRING>, title, author, year_from, year_to,
language)`` with a unique ``query_id``; criteria are nullable strings and NULL means "no
filter".  A batch of requests is answered by ONE plan, the same at every size:

    request words joined to the word table: the rarest word of each request; requests with
      an unknown word end here
    the bitmaps of that word (see quire.operators.word_blocks) are the candidate blocks
      -> the other words are looked up by (word, part, block)
      -> group by (query_id, block): bit_and of the masks of all words; set bits are the books
      -> left join catalogue on book_id, null-tolerant criteria predicates
      -> positions fetched for the surviving (query, book) pairs only

Over stored tables (see quire.sinks.index_store) only rows made from the requests move, in a batch
(``search_batch``) also the bitmaps of the words asked, dealt by block: the word table is bucketed by
word, the bitmaps by (word, part), postings and catalogue by book_id.
Declaring a search runs no job.  A literal request (``search``) knows its words, and reads only
the files of the word-ordered postings that hold them.

Words are matched exactly (no lower-casing or trimming of the request); a duplicate word
counts once; an empty word never matches, so it empties the result; a request with no
words matches nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.metadata import release_year
from quire.operators.criteria import TEXT_CRITERIA, CriteriaIndex, books_with_text
from quire.operators.word_blocks import LANES, books_of, not_empty, part_of, word_blocks, word_counts

CRITERIA = ("title", "author", "year_from", "year_to", "language")
#: ids of equal requests in one row of search_batch, about
SHARE = 128
#: words of a request whose positions are looked up without a copy of the book's words
FEW = 3

REQUEST_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("words", T.ArrayType(T.StringType())),
    *[T.StructField(c, T.StringType()) for c in CRITERIA],
])


@dataclass(frozen=True)
class SearchIndex:
    """What a search reads: ``postings`` (word, book_id, positions), ``blocks`` (bitmaps in
    ``parts`` parts), ``words`` (word, n_books), and ``find``: the postings of given words."""

    postings: DataFrame
    blocks: DataFrame
    words: DataFrame
    parts: int
    find: Callable[[list[str]], DataFrame]


def index_over(postings: DataFrame) -> SearchIndex:
    """An index over postings that are not stored: bitmaps and word counts are part of the plan."""
    blocks = word_blocks(postings)
    return SearchIndex(postings, blocks, word_counts(blocks), 1,
                       lambda words: postings.filter(F.col("word").isin(list(words))))


def _index(index: SearchIndex | DataFrame) -> SearchIndex:
    return index if isinstance(index, SearchIndex) else index_over(index)


def with_criteria_columns(requests: DataFrame) -> DataFrame:
    """Add any missing criterion column as NULL (no filter)."""
    for c in CRITERIA:
        if c not in requests.columns:
            requests = requests.withColumn(c, F.lit(None).cast("string"))
    return requests


def request_words(requests: DataFrame) -> DataFrame:
    """(query_id, word, n_words): one row per distinct word of each request."""
    distinct_words = F.array_distinct("words")
    return requests.select("query_id", F.explode(distinct_words).alias("word"),
                           F.size(distinct_words).alias("n_words"))


def blocks_of_words(index: SearchIndex, words: DataFrame) -> DataFrame:
    """Bitmaps of a table with a ``word`` column, its other columns kept.  Words are dealt to
    the parts of the bitmaps, which stay where they are."""
    return _with_parts(index, words).join(index.blocks, ["word", "part"])


def _with_parts(index: SearchIndex, words: DataFrame) -> DataFrame:
    return words.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(index.parts - 1))))


def candidates(index: SearchIndex | DataFrame, requests: DataFrame) -> DataFrame:
    """(query_id, n_words, word, book_id, positions) for every posting of a request word."""
    index = _index(index)
    keys = books_of(blocks_of_words(index, request_words(requests)), "query_id", "n_words", "word")
    return keys.join(index.postings, ["word", "book_id"]).select(
        "query_id", "n_words", "word", "book_id", "positions")


def rarest_words(requests: DataFrame, words: DataFrame) -> DataFrame:
    """(query_id, word, words): the request word found in the fewest books (ties: smallest
    word) and all words, for requests whose words are all in the index."""
    ranked = request_words(requests).join(words, "word")
    return (ranked.groupBy("query_id").agg(
        F.min_by("word", F.struct("n_books", "word")).alias("word"),
        F.collect_list("word").alias("words"), F.max("n_words").alias("n_words"))
        .filter(F.size("words") == F.col("n_words")).select("query_id", "word", "words"))


def matching_books(index: SearchIndex | DataFrame, requests: DataFrame) -> DataFrame:
    """(query_id, book_id) of books holding ALL distinct words of the request.

    Relational division on bitmaps: blocks of the rarest word are the only candidates, and
    every word of the request is looked up in them.  A request's words are bounded by the request."""
    index = _index(index)
    return _books_of_all(index, rarest_words(requests, index.words))


def _books_of_all(index: SearchIndex, asked: DataFrame) -> DataFrame:
    """(query_id, book_id) of books holding all ``words`` of ``asked`` (query_id, word, words), see :func:`rarest_words`."""
    return books_of(_holding_all(_held(index, asked)), "query_id")


def _held(index: SearchIndex, asked: DataFrame) -> DataFrame:
    """(query_id, n_words, word, block, masks): bitmaps of every word in the blocks of the rarest one."""
    seeds = blocks_of_words(index, asked)
    probes = seeds.select("query_id", "block", F.size("words").alias("n_words"), F.explode("words").alias("word")) \
        .withColumn("part", part_of(F.col("block"), index.parts))
    return probes.join(index.blocks, ["word", "part", "block"])


def _holding_all(held: DataFrame) -> DataFrame:
    """(query_id, block, masks): the books of a block that hold all words of the request."""
    return (held.groupBy("query_id", "block", "n_words")
            .agg(F.count("*").alias("n"), *[F.bit_and(m).alias(m) for m in LANES])
            .filter((F.col("n") == F.col("n_words")) & not_empty()))


def _holding_all_by_block(index: SearchIndex, asked: DataFrame) -> DataFrame:
    """(query_id, block, masks) as of :func:`_holding_all`, for many requests ``asked`` (query_id, word, words).

    The blocks of each request's rarest word and the bitmaps of the words asked meet block by block, so a
    request moves once a block, not once a word and block.  Requests pass by the bitmaps, held in memory."""
    words = _with_parts(index, asked.select(F.explode("words").alias("word"))).distinct()
    bitmaps = words.join(index.blocks, ["word", "part"]).select("block", "word", *LANES).repartition("block")
    seeds = blocks_of_words(index, asked).select("query_id", "block", "words").repartition("block")
    probes = seeds.select("query_id", "block", F.size("words").alias("n_words"), F.explode("words").alias("word"))
    return _holding_all(probes.join(bitmaps.hint("shuffle_hash"), ["block", "word"]))


def attach_positions(postings: DataFrame, matches: DataFrame, requests: DataFrame | None) -> DataFrame:
    """(query_id, book_id, ..., positions MAP<word, ARRAY<INT>>) for matched (query, book)
    pairs: positions are fetched for the survivors only, by a join on (word, book_id).  Without
    ``requests`` the matches bring their ``words`` along, see :func:`_positions_in_bucket`."""
    if requests is None:
        return _positions_in_bucket(postings, matches)
    wanted = matches.join(request_words(requests).select("query_id", "word"), "query_id")
    hits = postings.join(wanted, ["word", "book_id"])
    return (hits.groupBy(*[c for c in wanted.columns if c != "word"])
            .agg(F.map_from_entries(F.array_sort(F.collect_list(
                F.struct("word", "positions")))).alias("positions")))


def _positions_in_bucket(postings: DataFrame, matches: DataFrame) -> DataFrame:
    """``matches`` (book_id, words, ...) with ``positions`` for their words.

    Matches can be far more than the index, so they are neither sorted, nor multiplied by their words, nor
    grouped again: they pass by the books of their bucket, one row a book, held in memory.  Up to ``FEW``
    words are looked up as the rows pass; the book's words are copied only into rows of longer requests."""
    books = (postings.filter(F.col("word").isNotNull()).groupBy("book_id")
             .agg(F.map_from_entries(F.collect_list(F.struct("word", "positions"))).alias("_book")))
    at, few = lambda w: F.col("_book")[w], F.size("words") <= FEW
    first = F.map_from_arrays("words", F.slice(F.array(*[at(F.get("words", i)) for i in range(FEW)]), 1, F.size("words")))
    kept = [c for c in matches.columns if c != "words"]
    passed = matches.join(books.hint("shuffle_hash"), "book_id").select(
        *kept, "words", F.when(few, first).alias("_first"), F.when(~few, F.col("_book")).alias("_book"))
    every = F.map_from_arrays("words", F.transform("words", at))
    return passed.select(*kept, F.when(F.col("_book").isNull(), F.col("_first")).otherwise(every).alias("positions"))


def match_all_words(index: SearchIndex | DataFrame, requests: DataFrame) -> DataFrame:
    """(query_id, book_id, positions MAP<word, ARRAY<INT>>) for books holding ALL words."""
    index = _index(index)
    return attach_positions(index.postings, matching_books(index, requests), requests)


def _year_literal(c: Column) -> Column:
    # A year bound is an integer literal; anything else matches nothing.
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))


def _contains_ci(field: Column, value: Column) -> Column:
    return F.lower(field).contains(F.lower(value))


def _with_year(catalog: DataFrame) -> DataFrame:
    """``catalog`` with its release year: stored tables have it, parsed lines do not."""
    return catalog if "year" in catalog.columns else catalog.withColumn("year", release_year("date"))


def books_meeting(catalog: DataFrame, title=None, author=None, year_from=None, year_to=None,
                  language=None) -> DataFrame:
    """(book_id) of catalogue rows that meet every given literal criterion.  Year bounds
    are plain comparisons, so a stored catalogue prunes with them in the scan."""
    cat = _with_year(catalog)
    for name, value in (("title", title), ("author", author), ("language", language)):
        if value is not None:
            cat = cat.filter(_contains_ci(F.col(name), F.lit(value)))
    if year_from is not None:
        cat = cat.filter(F.col("year") >= int(year_from))
    if year_to is not None:
        cat = cat.filter(F.col("year") <= int(year_to))
    return cat.select("book_id")


def criteria_predicate(req_prefix: str = "") -> Column:
    """AND of every non-null criterion against catalogue columns title/author/year/
    language.  With any criterion set, a book without a catalogue row fails (V1)."""
    r = lambda c: F.col(f"{req_prefix}{c}")
    has_any = F.lit(False)
    for c in CRITERIA:
        has_any = has_any | r(c).isNotNull()
    year = F.col("year")
    checks = [
        r("title").isNull() | _contains_ci(F.col("title"), r("title")),
        r("author").isNull() | _contains_ci(F.col("author"), r("author")),
        r("year_from").isNull() | (year >= _year_literal(r("year_from"))),
        r("year_to").isNull() | (year <= _year_literal(r("year_to"))),
        r("language").isNull() | _contains_ci(F.col("language"), r("language")),
    ]
    ok = F.col("_has_meta")
    for chk in checks:
        ok = ok & F.coalesce(chk, F.lit(False))
    return ~has_any | ok


def filter_with_catalog(matches: DataFrame, catalog: DataFrame) -> DataFrame:
    """Keep rows whose book satisfies the criteria in their columns ``_req_title`` ..., and drop these columns."""
    cat = _with_year(catalog).select("book_id", "title", "author", "language", "year",
                                     F.lit(True).alias("_has_meta"))
    kept = [c for c in matches.columns if not c.startswith("_req_")]
    # the catalogue is held in memory bucket by bucket: matches can be far more, and are not sorted for the join
    return matches.join(cat.hint("shuffle_hash"), "book_id", "left").filter(criteria_predicate("_req_")).select(*kept)


def search_batch(index: SearchIndex | DataFrame, requests: DataFrame,
                 catalog: DataFrame | None = None) -> DataFrame:
    """Answer a table of requests: (query_id, book_id, positions MAP<word, ARRAY<INT>>).

    Criteria are applied to the matched (query_id, book_id) keys before any positions
    are fetched, so filtered-out books never move their position lists.  Requests of the same
    words and criteria are answered once, as the one with the smallest id.

    The answer has a row for each request and book, so nothing of that size may move often.  Words, criteria and
    the ids that asked (``SHARE`` a row) are joined to the bitmaps of the matches; these become one row a
    book then and are moved once, to the book's bucket, where they pass by catalogue and postings unsorted.
    The catalogue has one row a book."""
    index, requests = _index(index), with_criteria_columns(requests)
    criteria = [F.col(c).alias(f"_req_{c}") for c in CRITERIA] if catalog is not None else []
    asked = rarest_words(requests, index.words).join(requests.select("query_id", *CRITERIA), "query_id") \
        .withColumn("same", F.struct(F.sort_array("words").alias("words"), *criteria))
    kinds = asked.groupBy("same").agg(F.min("query_id").alias("kind"), F.min("word").alias("word"), F.count("*").alias("n"))
    share = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("n") / SHARE))
    shares = (asked.select("query_id", "same").join(kinds.select("same", "kind", "n"), "same")
              .groupBy("kind", "same", share.alias("share")).agg(F.collect_list("query_id").alias("ids"))
              .select(F.col("kind").alias("query_id"), "same.*", "ids"))
    held = _holding_all_by_block(index, kinds.select(F.col("kind").alias("query_id"), "word", "same.words"))
    # a merge join with the shares on the left gives all blocks of a share one after the other
    matches = books_of(shares.hint("merge").join(held, "query_id"), *shares.columns)
    if catalog is not None:
        matches = filter_with_catalog(matches, catalog)
    found = attach_positions(index.postings, matches, None)
    return found.select(F.explode("ids").alias("query_id"), "book_id", "positions")


def make_requests(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Request table from literal requests (the API surface: a handful of rows)."""
    data = [(int(r.get("query_id", i)), list(r["words"]), *[r.get(c) for c in CRITERIA])
            for i, r in enumerate(rows)]
    return spark.createDataFrame(data, REQUEST_SCHEMA)


def search(spark: SparkSession, index: SearchIndex | DataFrame, words: list[str], title=None,
           author=None, year_from=None, year_to=None, language=None,
           catalog: DataFrame | None = None, texts: CriteriaIndex | None = None) -> DataFrame:
    """One request: books containing all ``words`` and meeting every given criterion.

    Only the postings of its words are read.  Books are counted on keys first, criteria reach
    the catalogue scan, and positions are fetched for what is left.  With ``texts`` (of the same
    catalogue), title, author and language are looked up there instead.  A non-integer year bound raises
    ValueError here (V3); in batch tables it matches nothing.  Returns (book_id, positions) ordered by book_id.
    """
    for bound in (year_from, year_to):
        if bound is not None:
            int(bound)
    criteria = dict(title=title, author=author, year_from=year_from, year_to=year_to,
                    language=language)
    wanted = sorted(set(words), key=str)
    postings = _index(index).find(wanted)
    matches = (postings.groupBy("book_id").agg(F.count("*").alias("n"))
               .filter(F.col("n") == len(wanted)).select("book_id"))
    if texts is not None:
        for name in TEXT_CRITERIA:
            value = criteria.pop(name)
            if value is not None:
                matches = matches.join(books_with_text(texts, name, value), "book_id", "left_semi")
    if catalog is not None and any(v is not None for v in criteria.values()):
        matches = matches.join(books_meeting(catalog, **criteria), "book_id", "left_semi")
    hits = postings.join(matches, "book_id")
    return (hits.groupBy("book_id").agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("word", "positions")))).alias("positions")).orderBy("book_id"))


def books_by_word(index: SearchIndex | DataFrame, words: DataFrame) -> DataFrame:
    """Lookups word -> books for a table of words (J1); absent words give no rows."""
    return books_of(blocks_of_words(_index(index), words.select("word").distinct()), "word")


def positions_in_book(index: SearchIndex | DataFrame, keys: DataFrame) -> DataFrame:
    """Lookups (word, book_id) -> positions (J2) for a table of keys."""
    return (_index(index).postings.join(keys.select("word", "book_id"), ["word", "book_id"], "left_semi")
            .select("word", "book_id", "positions"))


def intersect_two_words(index: SearchIndex | DataFrame, requests: DataFrame) -> DataFrame:
    """Books holding both words of two-word requests, as a set intersection of the two
    per-word book sets: (query_id, book_id).

    The sets are bitmaps, intersected block by block; a request of another number of words raises
    when the query runs."""
    index = _index(index)
    bad = F.raise_error(F.lit("every request must have two words; matching_books takes any number"))
    two = requests.filter(F.col("query_id").isNotNull()).filter(
        F.when(F.coalesce(F.size("words"), F.lit(0)) == 2, F.lit(True)).otherwise(bad.cast("boolean")))
    sides = [blocks_of_words(index, two.select("query_id", F.get("words", i).alias("word"))) for i in (0, 1)]
    right = sides[1].select("query_id", "block", *[F.col(m).alias(f"r{m}") for m in LANES])
    both = sides[0].join(right, ["query_id", "block"]).select(
        "query_id", "block", *[F.col(m).bitwiseAND(F.col(f"r{m}")).alias(m) for m in LANES])
    return books_of(both.filter(not_empty()), "query_id")

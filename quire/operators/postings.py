"""Positional postings: build, merge, and the word -> books views.

Layout: one row per (word, book_id) with ``positions ARRAY<INT>`` ascending and distinct.
Rows stay per (word, book): a very frequent word is many rows spread over many tasks,
never one giant array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.sizing import deal

POSTINGS_SCHEMA = "word STRING, book_id BIGINT, positions ARRAY<INT>"

#: Parquet writer options for postings sorted by (word, book_id): ids and positions as bit-packed differences
#: (DELTA_BINARY_PACKED), which Spark's vectorized reader decodes block by block
DELTA_CODED = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#book_id": "false",
               "parquet.enable.dictionary#positions.list.element": "false"}


def build_postings(tokens: DataFrame) -> DataFrame:
    """(book_id, pos, word) tokens -> (word, book_id, positions).

    Positions are a set (re-delivered copies of a book collapse) in ascending order.
    The set is built partially inside each task and merged after one exchange on
    (book_id, word); a group is bounded by the length of the book.
    """
    return (tokens.groupBy("book_id", "word")
            .agg(F.array_sort(F.collect_set("pos")).alias("positions"))
            .select("word", "book_id", "positions"))


def row_postings(books: DataFrame, tokenizer: Callable[[Column], Column]) -> DataFrame:
    """(book_id, text) -> (word, book_id, positions) of every row for itself, without an exchange.

    The numbered tokens of a row are sorted by (word, position); a word's positions are then neighbours.
    Rows with one book id are not united here.
    """
    numbered = F.transform(tokenizer(F.col("text")), lambda w, i: F.struct(w.alias("word"), i.alias("pos")))
    # later steps read ``_t`` several times, so that the optimizer keeps it a column of its own
    t = books.select("book_id", F.sort_array(numbered).alias("_t"))
    word = lambda i: F.get(F.col("_t"), i)["word"]
    # no filter on the size: it would be pushed to the scan, and the text tokenized there a second time
    places = F.when(F.size("_t") > 0, F.sequence(F.lit(0), F.size("_t") - 1))
    first = F.filter(places, lambda i: (i == 0) | ~word(i).eqNullSafe(word(i - 1)))
    runs = t.select("book_id", "_t", first.alias("_first"))
    end = lambda k: F.coalesce(F.get(F.col("_first"), k + 1), F.size("_t"))
    held = F.transform("_first", lambda i, k: F.struct(word(i).alias("word"), F.transform(
        F.sequence(i, end(k) - 1), lambda j: F.get(F.col("_t"), j)["pos"]).alias("positions")))
    return runs.select("book_id", F.explode(held).alias("p")).select("p.word", "book_id", "p.positions")


def merge_postings(*parts: DataFrame, dealt: bool = False) -> DataFrame:
    """Set union of postings per (word, book_id) (several index runs into one index).

    Rows move once, as they are, dealt by book (a part has at most the book's vocabulary of it): nothing is grouped or
    sorted before that.  A group is bounded by the book's length times the parts that hold it.  ``dealt``: all rows of
    a book are in one partition already.
    """
    union = parts[0].select("word", "book_id", "positions")
    for p in parts[1:]:
        union = union.unionByName(p.select("word", "book_id", "positions"))
    union = union.filter(F.size("positions") > 0)
    if not dealt:
        union = deal(union, "book_id")
    held = F.array_compact(F.flatten(F.collect_list("positions")))
    return (union.groupBy("word", "book_id")
            .agg(F.array_sort(F.array_distinct(held)).alias("positions")))


def word_books(postings: DataFrame) -> DataFrame:
    """Distinct (word, book_id): the word -> books multimap as rows."""
    return postings.select("word", "book_id").distinct()


def word_book_counts(postings: DataFrame) -> DataFrame:
    """Per word: number of books, first and last book id (partial aggregation only)."""
    return (word_books(postings).groupBy("word")
            .agg(F.count("*").alias("n_books"), F.min("book_id").alias("first_book"),
                 F.max("book_id").alias("last_book")))


def keyed_postings(postings: DataFrame) -> DataFrame:
    """Postings with the display key ``word|book_id``."""
    return postings.select(F.concat_ws("|", "word", F.col("book_id").cast("string"))
                           .alias("key"), "word", "book_id", "positions")


def index_sizes(postings: DataFrame) -> DataFrame:
    """Entry counts of the two multimaps: (word, book) pairs and (word|book, pos) pairs."""
    return postings.agg(F.count("*").alias("word_book_entries"),
                        F.coalesce(F.sum(F.size("positions")), F.lit(0)).cast("bigint")
                        .alias("position_entries"))


def word_stats(postings: DataFrame) -> DataFrame:
    """(word, n_books): document frequency of every word (counts combine map-side)."""
    return postings.groupBy("word").agg(F.count("*").alias("n_books"))

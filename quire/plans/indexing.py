"""Index builds.

Batch: books -> tokenize + number + group by word + drop stopwords in the scan stage ->
postings.  A book that is one row moves nothing.  Ids that several rows have are found from the
ids alone; their tokens are united by partial aggregation per (book_id, word) inside each task and
one exchange on (book_id, word).  No exchange of tokens is keyed on the book alone: a book id delivered in
many copies (even a third of all rows) is tokenized by many tasks, and its postings are
spread over partitions by word.  When the input has fewer splits than the target
parallelism (small files, one row group), the books are first spread round-robin.

Incremental: the same build restricted to books whose key is not in the ledger; each
run's postings go to their own ``run=<id>`` partition first and the ledger rows
(doc_key, run) last, so a failed or replayed run is never visible (readers take only
committed runs) and a rerun adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.constants import STOPWORDS
from quire.functions.text import tokenize
from quire.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small, has_at_most, spread
from quire.operators.postings import build_postings, row_postings
from quire.operators.row_marks import FILE, ROW, marked_rows, marks_of, with_places
from quire.operators.tokens import Tokenizer, index_tokens, remove_stopwords
from quire.operators.word_blocks import BLOCKS_SCHEMA
from quire.session import work_path
from quire.sinks.index_store import (
    append_ledger, new_run_id, read_ledger, read_postings, save_index_table, write_run,
)


def build_index(books: DataFrame, tokenizer: Tokenizer = tokenize, stopwords=STOPWORDS,
                partitions: int | None = None,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """(word, book_id, positions) for a DataFrame of (book_id, text).

    Two jobs on the ids alone find those that several rows have.  Beyond a bound of such ids
    the tokens of all books go through the exchange."""
    src = books.select("book_id", "text")
    ids = _repeated_ids(src)
    if not has_at_most(ids, max_broadcast_rows):
        return build_postings(index_tokens(spread(src, partitions), tokenizer, stopwords))
    same = F.col("book_id").eqNullSafe(F.col("_repeated"))
    once, again = [spread(src.join(F.broadcast(ids), same, how), partitions) for how in ("left_anti", "left_semi")]
    return remove_stopwords(row_postings(once, tokenizer), stopwords).unionByName(
        build_postings(index_tokens(again, tokenizer, stopwords)))


def _repeated_ids(books: DataFrame) -> DataFrame:
    """(_repeated): book ids of more than one row, stored in the shared work folder; no text is read."""
    path = work_path(books.sparkSession, "repeated-ids")
    (books.groupBy("book_id").agg(F.count("*").alias("n")).filter("n > 1")
     .select(F.col("book_id").cast("bigint").alias("_repeated")).write.parquet(path))
    return books.sparkSession.read.schema("_repeated BIGINT").parquet(path)


def new_keys(books: DataFrame, ledger: DataFrame) -> DataFrame:
    """Distinct keys of ``books`` that the ledger does not list; only keys are read."""
    return books.select("doc_key").distinct().join(
        ledger.select("doc_key"), "doc_key", "left_anti")


def with_keys(books: DataFrame, keys: DataFrame,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Books of the given distinct keys.  Keys that a bounded count proves few are broadcast,
    so that book text does not move; more keys meet the books in a shuffle."""
    return books.join(broadcast_if_small(keys, max_broadcast_rows), "doc_key", "left_semi")


def new_books(books: DataFrame, ledger: DataFrame,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Books whose key is not in the ledger."""
    return with_keys(books, new_keys(books, ledger), max_broadcast_rows)


def index_new_books(books: DataFrame, index_path: str, ledger_path: str,
                    tokenizer: Tokenizer = tokenize, stopwords=STOPWORDS,
                    partitions: int | None = None) -> DataFrame:
    """Index the books of ``books`` (doc_key, book_id, text) that the ledger does not
    list yet; returns the keys that were new in this run.

    The new keys are written to the shared work folder once; postings and ledger are both
    made from that table, so both see the same set of new books.  Books that are rows of a Parquet table are
    picked by their place (quire.operators.row_marks): text is never an exchange input, however many are
    new.  Other books (text files, a micro-batch) meet the keys as in :func:`with_keys`.  Several rows with
    one key (a file delivered twice) need no dedup of the text: their positions collapse in the (book_id, word)
    set aggregation; only the ledger keys are made distinct.
    """
    spark = books.sparkSession
    valid = books.filter((F.col("doc_key") != "") & F.col("book_id").isNotNull())
    staged, run = work_path(spark, "new-keys"), new_run_id()
    placed = with_places(valid.select("doc_key", "book_id", "text"))
    if placed is None:
        new_keys(valid, read_ledger(spark, ledger_path)).write.parquet(staged)
        keys = spark.read.schema("doc_key STRING").parquet(staged)
        fresh = with_keys(valid, keys)
    else:
        _new_places(placed, read_ledger(spark, ledger_path)).write.parquet(staged)
        places = spark.read.schema(f"doc_key STRING, {FILE} STRING, {ROW} BIGINT").parquet(staged)
        keys = places.select("doc_key").distinct()
        marks = work_path(spark, "new-rows")
        marks_of(places).write.parquet(marks)
        fresh = marked_rows(placed, spark.read.schema(BLOCKS_SCHEMA).parquet(marks))
    write_run(build_index(fresh, tokenizer, stopwords, partitions), index_path, run)
    append_ledger(keys, ledger_path, run)        # the commit record, written last
    return keys


def _new_places(placed: DataFrame, ledger: DataFrame) -> DataFrame:
    """(doc_key, file, row) of the books that the ledger does not list; only keys are read."""
    return placed.select("doc_key", FILE, ROW).join(ledger.select("doc_key"), "doc_key", "left_anti")


def compact_index(index_path: str, ledger_path: str, table_path: str, buckets: int,
                  spark=None) -> str:
    """Write the committed runs of ``index_path`` (books indexed under several keys
    merged) as a book-bucketed index table at ``table_path`` that searches read without
    shuffling; returns the table name."""
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    return save_index_table(read_postings(spark, index_path, ledger_path), table_path,
                            buckets)

"""Book store and catalogue-line log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.row_marks import FILE, ROW, marked_rows, marks_of, with_places
from quire.operators.word_blocks import BLOCKS_SCHEMA
from quire.session import work_path
from quire.sinks.commit_log import append_entry, file_system
from quire.sinks.index_store import read_folder

STORE_SCHEMA = "book_id BIGINT, doc_key STRING, text STRING, batch BIGINT"


def latest_books(books: DataFrame, order_col: str = "arrival") -> DataFrame:
    """(book_id, doc_key, text), one row per book id: the last arrival overwrites earlier copies, and of
    one arrival the greatest key wins.

    Rows of a Parquet table are compared by key and place alone, in a job that reads no text and combines the
    copies of an id before its shuffle; the winners' texts then come straight from the scan
    (quire.operators.row_marks).  Copies equal in arrival and key go to the later place (file, row).  Rows of
    other sources travel with one text each, and there the greatest text wins; rows without id are one book."""
    placed = with_places(books.select("book_id", "doc_key", "text", order_col))
    if placed is None:
        return (books.groupBy("book_id").agg(F.max(F.struct(order_col, "doc_key", "text")).alias("b"))
                .select("book_id", "b.doc_key", "b.text"))
    spark = books.sparkSession
    winners = (placed.groupBy("book_id").agg(F.max(F.struct(order_col, "doc_key", FILE, ROW)).alias("b"))
               .select(f"b.{FILE}", f"b.{ROW}"))
    path = work_path(spark, "latest-rows")
    marks_of(winners).write.parquet(path)
    return marked_rows(placed, spark.read.schema(BLOCKS_SCHEMA).parquet(path)).select("book_id", "doc_key", "text")


def _claim_batch(spark: SparkSession, path: str) -> int:
    """A batch number that no other writer has, above those of the stored batches."""
    _, folder, fs = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    number = 1 + max((int(n[6:]) for n in names if n.startswith("batch=") and n[6:].isdigit()), default=0)
    while not append_entry(spark, f"{path}/_batches", number, {}):
        number += 1
    return number


def store_books(books: DataFrame, path: str, order_col: str = "arrival") -> None:
    """Store the latest copy of every book of ``books``; each replaces the stored book of
    its id, and all other stored books stay.  A call adds one batch folder; of two calls at the same time
    each has a folder of its own."""
    batch = _claim_batch(books.sparkSession, path)
    latest_books(books, order_col).write.parquet(f"{path}/batch={batch}")


def append_books(books: DataFrame, path: str) -> None:
    """Store ``books`` (book_id, doc_key, text) as they come, as one batch; no row moves.  They replace the
    stored books of their ids when they are read, and of copies in the batch :func:`read_books` takes one."""
    batch = _claim_batch(books.sparkSession, path)
    books.select("book_id", "doc_key", "text").write.parquet(f"{path}/batch={batch}")


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, doc_key, text): every stored book as its last batch left it."""
    return latest_books(read_folder(spark, path, STORE_SCHEMA), "batch")


def append_catalog_lines(lines: DataFrame, path: str) -> None:
    """Append metadata lines to the text log (reruns append duplicates; the reader keeps
    the last line per id)."""
    lines.select("line").write.mode("append").text(path)

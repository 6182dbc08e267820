"""From fetched pages to the index in one call: records, metadata log, book store, incremental index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.html import body_text
from quire.functions.text import strip_header
from quire.plans.crawling import catalog_lines_of, extract_book_records
from quire.plans.indexing import index_new_books
from quire.session import work_path
from quire.sinks.books_store import append_catalog_lines, append_books, read_books
from quire.sinks.index_store import read_ledger
from quire.sinks.run_levels import FAN, merge_runs

#: folders under the root of a crawl
CATALOG_LOG, BOOKS, INDEX, LEDGER = "catalog_lines", "books", "index", "ledger"


def crawl_to_index(book_pages: DataFrame, downloads: DataFrame, root: str, fan: int = FAN) -> DataFrame:
    """Take fetched book pages (href, html) and fetched texts (download_url, html) into the folders under ``root``.

    Every page with a heading, a plain-text link and an id gives a line of the metadata log.  The text behind
    its link (body text, header cut off) becomes book ``<id>``; a book that was stored before is replaced.  Books
    that the ledger does not list are indexed, and the runs of the index are merged ``fan`` at a time.  Returns the
    keys that were new.  Pages whose text was not fetched yet give their line only and are taken up when
    they come again with it.  Pages or texts that are null are skipped; an id that is no integer is no book; of
    several texts of one book in a call the last stored place wins.  Calls may be repeated: lines are appended
    again (readers take a book's last line), nothing is indexed twice.

    The records are narrow and written once; texts meet them on the link, and move only where adaptive execution
    finds the records too large to broadcast.
    """
    spark = book_pages.sparkSession
    path = work_path(spark, "crawl-records")
    extract_book_records(book_pages).write.parquet(path)
    records = spark.read.parquet(path)
    append_catalog_lines(catalog_lines_of(records), f"{root}/{CATALOG_LOG}")
    wanted = records.select("download_url", F.col("book_id").try_cast("int").cast("bigint").alias("book_id")) \
        .filter("book_id is not null").distinct()
    texts = downloads.select("download_url", "html").join(wanted, "download_url").select(
        "book_id", F.col("book_id").cast("string").alias("doc_key"), strip_header(body_text("html")).alias("text"))
    append_books(texts.filter("text is not null"), f"{root}/{BOOKS}")
    index, ledger = f"{root}/{INDEX}", f"{root}/{LEDGER}"
    new = index_new_books(read_books(spark, f"{root}/{BOOKS}"), index, ledger)
    merge_runs(spark, index, read_ledger(spark, ledger), fan)
    return new

"""Crawl extraction over stored pages: listing pages -> book links; book pages -> records
and metadata lines.  (Fetching over HTTP is outside Spark; pages arrive as a table.)"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.html import (
    absolute_url, book_links, download_link, heading, language_cell, link_book_id,
    release_date, split_author, split_title,
)
from quire.functions.metadata import format_metadata_line


def extract_links(listing: DataFrame) -> DataFrame:
    """(start_index, link_no, href) for every book link of every listing page."""
    return listing.select("start_index",
                          F.posexplode(book_links("html")).alias("link_no", "href"))


def links_per_page(listing: DataFrame) -> DataFrame:
    """(start_index, n_links); a page with zero links is where the crawler stops."""
    return listing.select("start_index", F.size(book_links("html")).alias("n_links"))


def extract_book_records(book_pages: DataFrame) -> DataFrame:
    """(href, book_id, title, author, release_date, language, download_url) per book
    page.  Pages without ``h1``, without a 'Plain Text UTF-8' link, or whose link is too
    short for an id are dropped, as the crawler skips them."""
    # as the output of a generator the fields are computed once: filters on them stay above it
    rec = book_pages.select("href", F.inline(F.array(F.struct(
        heading("html").alias("heading"), release_date("html").alias("release_date"),
        language_cell("html").alias("language"), download_link("html").alias("download"),
        link_book_id("href").alias("book_id")))))
    return (rec.filter(F.col("heading").isNotNull() & F.col("download").isNotNull()
                       & F.col("book_id").isNotNull())
            .select("href", "book_id", split_title("heading").alias("title"),
                    split_author("heading").alias("author"), "release_date", "language",
                    absolute_url("download").alias("download_url")))


def catalog_lines_of(records: DataFrame) -> DataFrame:
    """Metadata line of each extracted record."""
    return records.select(format_metadata_line("book_id", "title", "author",
                                               "release_date", "language").alias("line"))

"""Stand-in inputs derived from the driver tables.

The driver ships book texts (``documents``), passages (``benchmark``) and web pages
(``pages``), but no metadata log, no catalogue HTML and no search requests.  These
functions only shape driver rows into the schemas the jobs read; they do none of the
jobs' work.  Beyond formatting, they only choose which rows a stand-in holds (e.g. the
books a second crawl re-delivers are those whose text had a header) and choose request
words with the library tokenizer, as a user would type them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.constants import BASE_URL
from quire.functions.metadata import format_metadata_line
from quire.operators.tokens import is_stopword
from quire.functions.text import tokenize, strip_header

# --- layout of the stand-ins ------------------------------------------------------------
FIRST_SENTENCE = r"^[^.!?\r\n]*"   # title = the book's first sentence, or its first line if that ends sooner
FIRST_TWO_WORDS = r"^[^ ]+ [^ ]+"
LANG_NAMES = (("en", "English"), ("fr", "French"), ("de", "German"), ("es", "Spanish"))
UNKNOWN_DATE_EVERY = 10         # every 10th id has release date "Unknown"
NO_DOWNLOAD_EVERY = 17          # every 17th book page has no plain-text link
DATE_ORIGIN = "1995-01-01"      # release date = origin + (id * 37 mod 9000) days
DATE_MULT, DATE_SPAN = 37, 9000
BOOKS_PER_LISTING = 25


def _lang_name(lang: Column) -> Column:
    out = F.lit("Unknown")
    for code, name in reversed(LANG_NAMES):
        out = F.when(lang == code, F.lit(name)).otherwise(out)
    return out


def _title(text: Column) -> Column:
    return F.regexp_extract(text, FIRST_SENTENCE, 0)


def _release_date(doc_id: Column) -> Column:
    d = F.date_add(F.lit(DATE_ORIGIN).cast("date"),
                   ((doc_id * DATE_MULT) % DATE_SPAN).cast("int"))
    return F.when(doc_id % UNKNOWN_DATE_EVERY == 0, F.lit("Unknown")) \
        .otherwise(F.date_format(d, "MMM d, yyyy"))


def catalog_fields(documents: DataFrame, text: Column | None = None) -> DataFrame:
    """(book_id, title, author, release_date, language) per document."""
    text = F.col("text") if text is None else text
    return documents.select(
        F.col("doc_id").alias("book_id"), _title(text).alias("title"),
        F.concat(F.lit("Author "), F.col("source")).alias("author"),
        _release_date(F.col("doc_id")).alias("release_date"),
        _lang_name(F.col("lang")).alias("language"))


def catalog_lines(documents: DataFrame, delivery: int = 1,
                  text: Column | None = None) -> DataFrame:
    """(line_no, line): one metadata line per document; ``line_no`` orders the log by
    (delivery, id), i.e. lines appended in id order, crawl after crawl."""
    f = catalog_fields(documents, text)
    return f.select(F.struct(F.lit(delivery).alias("delivery"),
                             F.col("book_id").alias("seq")).alias("line_no"),
                    format_metadata_line("book_id", "title", "author", "release_date",
                                         "language").alias("line"))


def recrawled_catalog_lines(documents: DataFrame) -> DataFrame:
    """The log after a second crawl that re-delivered every book whose text had a
    header, now titled from the header-stripped text: original lines, then the new ones
    appended after them."""
    has_header = F.size(F.split("text", r"\*\*\*.*?\*\*\*", 2)) == 2
    again = catalog_lines(documents.filter(has_header), 2, strip_header("text"))
    return catalog_lines(documents).unionByName(again)


def book_pages(documents: DataFrame) -> DataFrame:
    """(href, html) of a catalogue page per book: heading "TITLE by AUTHOR", a language
    cell, a release-date cell (missing for unknown dates) and the plain-text link
    (missing on some pages)."""
    f = catalog_fields(documents).select(
        "book_id", F.translate("title", "<", " ").alias("title"), "author",
        "release_date", "language")
    date_cell = F.when(F.col("release_date") == "Unknown", F.lit("")).otherwise(
        F.concat(F.lit('<td itemprop="datePublished">'), "release_date", F.lit("</td>")))
    link = F.when(F.col("book_id") % NO_DOWNLOAD_EVERY == 0, F.lit("")).otherwise(
        F.concat(F.lit('<a href="/ebooks/'), F.col("book_id").cast("string"),
                 F.lit('.txt.utf-8">Plain Text UTF-8</a>')))
    html = F.concat(F.lit("<html><body><h1>"), "title", F.lit(" by "), "author",
                    F.lit("</h1><table><tr><td>"), "language", F.lit("</td>"), date_cell,
                    F.lit("</tr></table>"), link, F.lit("</body></html>"))
    return f.select(F.concat(F.lit("/ebooks/"), F.col("book_id").cast("string"))
                    .alias("href"), html.alias("html"))


def downloaded_texts(documents: DataFrame) -> DataFrame:
    """(download_url, html): the text behind each book's plain-text link, as the body of a page."""
    text = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return documents.select(
        F.concat(F.lit(BASE_URL + "/ebooks/"), F.col("doc_id").cast("string"), F.lit(".txt.utf-8")).alias("download_url"),
        F.concat(F.lit("<html><body>"), text, F.lit("</body></html>")).alias("html"))


def listing_pages(documents: DataFrame) -> DataFrame:
    """(start_index, html): 25 books per listing page in id order, after one anchor that
    is not a book link.  A page groups at most 25 rows."""
    li = documents.select(
        (F.floor(F.col("doc_id") / BOOKS_PER_LISTING) * BOOKS_PER_LISTING).cast("int")
        .alias("start_index"), "doc_id",
        F.concat(F.lit('<li class="booklink"><a href="/ebooks/'),
                 F.col("doc_id").cast("string"), F.lit('">x</a></li>')).alias("li"))
    pages = li.groupBy("start_index").agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "li"))).alias("items"))
    return pages.select("start_index", F.concat(
        F.lit('<html><body><a href="/ebooks/search">all</a><ul>'),
        F.array_join(F.transform("items", lambda x: x["li"]), ""),
        F.lit("</ul></body></html>")).alias("html"))


def _request_words(text: Column) -> Column:
    return F.array_distinct(F.filter(tokenize(text), lambda w: ~is_stopword(w)))


def passage_requests(benchmark: DataFrame) -> DataFrame:
    """(query_id, words): every passage of ``benchmark`` as a request made of its
    distinct non-stopword words (the words a user would type to find the passage)."""
    return benchmark.select(F.col("item_id").cast("bigint").alias("query_id"),
                            _request_words(F.col("text")).alias("words"))


# --- criteria profiles of the title-request workload --------------------------------------
# (title, author, year_from, year_to, language); profile = query_id mod 5.
CRITERIA_PROFILES = (
    (None, None, None, None, None),
    (None, None, "2000", None, "english"),
    (None, "author src1", None, "2010", None),
    ("e", None, "1990", "2015", None),
    (None, None, None, None, "German"),
)


def title_requests(documents: DataFrame) -> DataFrame:
    """(query_id, words, title, author, year_from, year_to, language): one request per
    book, made of the distinct non-stopword words of its title, with one of the criteria
    profiles above."""
    base = documents.select(F.col("doc_id").alias("query_id"),
                            _request_words(_title(F.col("text"))).alias("words"))
    profile = (F.col("query_id") % len(CRITERIA_PROFILES)).cast("int")
    out = base
    for i, name in enumerate(("title", "author", "year_from", "year_to", "language")):
        col = F.lit(None).cast("string")
        for p, values in enumerate(CRITERIA_PROFILES):
            if values[i] is not None:
                col = F.when(profile == p, F.lit(values[i])).otherwise(col)
        out = out.withColumn(name, col)
    return out

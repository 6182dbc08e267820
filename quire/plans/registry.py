"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (or data Spark derives from them) in full.  Results
are flattened to scalar columns (arrays joined into strings) so they compare by value.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.arrays import flatten_positions, join_ints, positions_text
from quire.functions.html import body_text, download_link, heading, language_cell
from quire.functions.html import absolute_url, link_book_id, release_date
from quire.functions.html import split_author, split_title
from quire.functions.metadata import release_year
from quire.functions.text import (
    book_id_from_path, doc_key_from_path, parse_query, strip_header, tokenize,
)
from quire.operators import catalog as cat
from quire.operators.claims import claim_pages, claim_state, finish_pages, with_claims
from quire.operators.criteria import books_containing
from quire.operators.forward import fragments_of_hits
from quire.operators import crawl, ledger, postings as post, search as srch, tokens as tok
from quire.plans import crawling, fixtures
from quire.plans.crawl_flow import INDEX, LEDGER, crawl_to_index
from quire.plans.indexing import build_index, index_new_books
from quire.session import table_path, work_path
from quire.sinks.books_store import append_catalog_lines, read_books, store_books
from quire.sinks.criteria_store import open_criteria_index, save_criteria_index
from quire.sinks.forward_store import open_forward_table, save_forward_table
from quire.sinks.index_store import (
    append_ledger, new_run_id, open_catalog_table, open_index_table, read_ledger, read_postings,
    save_catalog_table, save_index_table, write_run,
)
from quire.sinks.results import result_json
from quire.sinks.run_levels import expire_runs, merge_runs
from quire.sources.books import books_from_table
from quire.sources.catalog import read_catalog_lines
from quire.sources.stopwords import stopwords_frame

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    """Register a query under ``name`` (the key in ``queries()`` and ``oracle_sql()``)."""
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


# ---------------------------------------------------------------- shared inputs ----------

def documents(spark, sf):
    return spark.read.parquet(table_path(sf, "documents"))


def books(spark, sf):
    return books_from_table(documents(spark, sf))


def index(spark, sf):
    return build_index(books(spark, sf))


_STORED: dict = {}


def _session_key(spark) -> str:
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def stored_index(spark, sf):
    """The index of ``documents``, saved once per session in the shared work folder and
    opened from there."""
    key = (_session_key(spark), sf)
    if key not in _STORED:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = work_path(spark, "index-table")
        save_index_table(index(spark, sf), path, buckets)
        _STORED[key] = open_index_table(spark, path)
    return _STORED[key]


def stored_catalog(spark, sf):
    """The parsed catalogue of the metadata log, saved once per session bucketed like the
    index (criteria joins of the search queries stay inside buckets)."""
    key = (_session_key(spark), sf, "catalog")
    if key not in _STORED:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = work_path(spark, "catalog-table")
        save_catalog_table(catalog(spark, sf), path, buckets)
        _STORED[key] = open_catalog_table(spark, path)
    return _STORED[key]


def stored_forward(spark, sf):
    """The forward index of ``documents``, saved once per session."""
    key = (_session_key(spark), sf, "forward")
    if key not in _STORED:
        path = work_path(spark, "forward-table")
        save_forward_table(books(spark, sf), path, int(spark.conf.get("spark.sql.shuffle.partitions")))
        _STORED[key] = open_forward_table(spark, path)
    return _STORED[key]


def stored_criteria(spark, sf):
    """The n-gram index of the catalogue's text fields, saved once per session."""
    key = (_session_key(spark), sf, "criteria")
    if key not in _STORED:
        path = work_path(spark, "criteria-index")
        save_criteria_index(stored_catalog(spark, sf), path, int(spark.conf.get("spark.sql.shuffle.partitions")))
        _STORED[key] = open_criteria_index(spark, path)
    return _STORED[key]


def flat_postings(p: DataFrame) -> DataFrame:
    return p.select("word", "book_id", join_ints("positions").alias("positions"))


def catalog(spark, sf):
    return cat.load_catalog(fixtures.catalog_lines(documents(spark, sf)))


def passages(spark, sf):
    return fixtures.passage_requests(spark.read.parquet(table_path(sf, "benchmark")))


def passage_matches(spark, sf):
    return srch.match_all_words(stored_index(spark, sf), passages(spark, sf))


def plain_title_requests(spark, sf):
    return fixtures.title_requests(documents(spark, sf)).select("query_id", "words")


def _criteria_search(spark, sf, **criteria):
    req = plain_title_requests(spark, sf)
    for k, v in criteria.items():
        req = req.withColumn(k, F.lit(v))
    return srch.search_batch(stored_index(spark, sf), req, stored_catalog(spark, sf)) \
        .select("query_id", "book_id")


# ---------------------------------------------------------------- sources ----------------

@register("scan_books")
def scan_books(spark, sf):
    return books(spark, sf)


@register("stopwords")
def stopwords(spark, sf):
    """Stopword list (S3) applied to the corpus: how many tokens each stopword removes."""
    sw = F.broadcast(stopwords_frame(spark))  # fixed 176-row list
    t = tok.token_positions(books(spark, sf))
    return t.join(sw, "word").groupBy("word").agg(F.count("*").alias("n_removed"))


@register("book_id_from_path")
def book_id_from_path_q(spark, sf):
    d = documents(spark, sf).select(F.concat(
        F.lit("C:\\corpus\\"), "source", F.lit("\\00"), F.col("doc_id").cast("string"),
        F.lit(".txt")).alias("path"))
    return d.select("path", doc_key_from_path("path").alias("doc_key"),
                    book_id_from_path("path").alias("book_id"))


# ---------------------------------------------------------------- tokenizer -------------

@register("tokenize")
def tokenize_q(spark, sf):
    t = books(spark, sf).select("book_id", tokenize("text").alias("t"))
    return t.select("book_id", F.size("t").alias("n_tokens"),
                    F.array_join("t", " ").alias("tokens"))


@register("token_positions")
def token_positions(spark, sf):
    return tok.token_positions(books(spark, sf))


@register("remove_stopwords")
def remove_stopwords(spark, sf):
    return tok.index_tokens(books(spark, sf))


@register("custom_tokenizer")
def custom_tokenizer(spark, sf):
    from quire.functions.custom import letter_run_tokenizer
    return tok.index_tokens(books(spark, sf), tokenizer=letter_run_tokenizer)


# ---------------------------------------------------------------- index -----------------

@register("build_postings")
def build_postings(spark, sf):
    p = index(spark, sf)
    return p.select("word", "book_id", join_ints("positions").alias("positions"),
                    F.size("positions").alias("n_positions"))


@register("merge_postings")
def merge_postings(spark, sf):
    """Raw texts indexed in one run, header-stripped re-downloads in another: the merged
    index holds the union of both position sets per (word, book)."""
    d = documents(spark, sf)
    raw = build_index(books_from_table(d))
    stripped = build_index(books_from_table(d.withColumn("text", strip_header("text"))))
    return flat_postings(post.merge_postings(raw, stripped))


@register("word_books")
def word_books(spark, sf):
    return post.word_books(index(spark, sf))


@register("word_to_books")
def word_to_books(spark, sf):
    return post.word_book_counts(index(spark, sf))


@register("postings_keyed")
def postings_keyed(spark, sf):
    return post.keyed_postings(index(spark, sf)).select(
        "key", join_ints("positions").alias("positions"))


@register("index_sizes")
def index_sizes(spark, sf):
    return post.index_sizes(index(spark, sf))


def _incremental(spark, sf):
    """Two incremental runs into one index folder, once per session: English books first,
    then the whole corpus (English books are skipped by the ledger)."""
    key = (_session_key(spark), sf, "incremental")
    if key not in _STORED:
        idx, led = work_path(spark, "index"), work_path(spark, "ledger")
        d = documents(spark, sf)
        index_new_books(books_from_table(d.filter(F.col("lang") == "en")), idx, led)
        index_new_books(books_from_table(d), idx, led)
        _STORED[key] = idx, led
    return _STORED[key]


@register("incremental_index")
def incremental_index(spark, sf):
    idx, led = _incremental(spark, sf)
    return flat_postings(read_postings(spark, idx, led))


@register("tiered_index")
def tiered_index(spark, sf):
    """One incremental run for each language and one for the rest, merged two at a time into levels; the
    folders that merges replaced are removed before the index is read."""
    idx, led = work_path(spark, "index"), work_path(spark, "ledger")
    d = documents(spark, sf)
    for lang, _ in fixtures.LANG_NAMES:
        index_new_books(books_from_table(d.filter(F.col("lang") == lang)), idx, led)
    index_new_books(books_from_table(d), idx, led)
    merge_runs(spark, idx, read_ledger(spark, led), fan=2)
    expire_runs(spark, idx, grace=0)
    return flat_postings(read_postings(spark, idx, led))


@register("side_by_side_index")
def side_by_side_index(spark, sf):
    """Two jobs that did not see each other index the same books; readers merge them."""
    idx, led = work_path(spark, "index"), work_path(spark, "ledger")
    b = books(spark, sf)
    for _ in range(2):
        run = new_run_id()
        write_run(build_index(b), idx, run)
        append_ledger(b.select("doc_key").distinct(), led, run)
    return flat_postings(read_postings(spark, idx, led))


@register("indexed_books")
def indexed_books(spark, sf):
    _, led = _incremental(spark, sf)
    return read_ledger(spark, led).select("doc_key")


@register("nbooks")
def nbooks(spark, sf):
    _, led = _incremental(spark, sf)
    return ledger.ledger_size(read_ledger(spark, led))


@register("is_indexed")
def is_indexed(spark, sf):
    led = work_path(spark, "ledger")
    d = documents(spark, sf)
    append_ledger(books_from_table(d.filter(F.col("lang") == "en")), led)
    return ledger.mark_indexed(books(spark, sf).select("doc_key", "book_id"),
                               read_ledger(spark, led))


@register("store_books")
def store_books_q(spark, sf):
    """Books delivered twice (raw, then header-stripped when a header exists) in two calls:
    the second replaces the books it brings and leaves the others."""
    d = documents(spark, sf)
    first = books_from_table(d).withColumn("arrival", F.lit(1))
    has_header = F.size(F.split("text", r"\*\*\*.*?\*\*\*", 2)) == 2
    again = books_from_table(d.filter(has_header).withColumn("text", strip_header("text"))) \
        .withColumn("arrival", F.lit(2))
    path = work_path(spark, "books")
    store_books(first, path)
    store_books(again, path)
    return read_books(spark, path)


@register("stream_index")
def stream_index(spark, sf):
    """Books land as files, and a Structured Streaming query indexes them; German books land
    again, and the query goes on from its checkpoint."""
    from quire.streaming.ingest import start_stream_index
    src = work_path(spark, "landing")
    d = documents(spark, sf)
    idx, led, ck = work_path(spark, "index"), work_path(spark, "ledger"), work_path(spark, "ckpt")
    for landed in (d, d.filter(F.col("lang") == "de")):
        books_from_table(landed).write.mode("append").parquet(src)
        start_stream_index(spark, src, idx, led, ck, available_now=True).awaitTermination()
    return flat_postings(read_postings(spark, idx, led))


# ---------------------------------------------------------------- catalogue -------------

def _catalog_cols(df):
    return df.select("book_id", "title", "author", "date", "language")


@register("catalog_lines")
def catalog_lines(spark, sf):
    return fixtures.catalog_lines(documents(spark, sf)).select("line")


@register("parse_catalog")
def parse_catalog(spark, sf):
    p = cat.parse_catalog(fixtures.catalog_lines(documents(spark, sf)))
    return p.select("book_id", "title", "author", "date", "language",
                    F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("keys"))


@register("load_catalog")
def load_catalog(spark, sf):
    return _catalog_cols(catalog(spark, sf))


@register("catalog_last_wins")
def catalog_last_wins(spark, sf):
    return _catalog_cols(cat.load_catalog(fixtures.recrawled_catalog_lines(documents(spark, sf))))


@register("catalog_log")
def catalog_log(spark, sf):
    """The metadata log as text files: two crawls append their lines, the reader takes the
    last line of every book."""
    path = work_path(spark, "catalog-log")
    lines = fixtures.recrawled_catalog_lines(documents(spark, sf))
    for delivery in (1, 2):
        append_catalog_lines(lines.filter(F.col("line_no.delivery") == delivery), path)
    return _catalog_cols(cat.load_catalog(read_catalog_lines(spark, path)))


@register("crawl_to_catalog")
def crawl_to_catalog(spark, sf):
    """Book pages to records, records to lines of the metadata log, the log to the catalogue."""
    path = work_path(spark, "catalog-log")
    records = crawling.extract_book_records(_book_pages(spark, sf))
    append_catalog_lines(crawling.catalog_lines_of(records), path)
    return _catalog_cols(cat.load_catalog(read_catalog_lines(spark, path)))


@register("crawl_to_index")
def crawl_to_index_q(spark, sf):
    """Fetched book pages and fetched texts to metadata log, book store and index in one call, twice: the
    second call finds every book in the ledger."""
    root, d = work_path(spark, "crawl"), documents(spark, sf)
    for _ in range(2):
        crawl_to_index(_book_pages(spark, sf), fixtures.downloaded_texts(d), root)
    return flat_postings(read_postings(spark, f"{root}/{INDEX}", f"{root}/{LEDGER}"))


@register("release_year")
def release_year_q(spark, sf):
    # year as text: a nullable integer column would hash differently across engines
    return catalog(spark, sf).select("book_id", "date",
                                     release_year("date").cast("string").alias("year"))


# ---------------------------------------------------------------- lookups / search ------

@register("books_by_word")
def books_by_word(spark, sf):
    words = passages(spark, sf).select(F.explode("words").alias("word"))
    return srch.books_by_word(stored_index(spark, sf), words)


@register("positions_in_book")
def positions_in_book(spark, sf):
    keys = plain_title_requests(spark, sf).select(
        F.explode("words").alias("word"), F.col("query_id").alias("book_id"))
    return flat_postings(srch.positions_in_book(stored_index(spark, sf), keys))


@register("parse_query")
def parse_query_q(spark, sf):
    raw = spark.read.parquet(table_path(sf, "benchmark")).select(
        F.col("item_id").alias("query_id"), F.regexp_replace("text", r"\s", "+").alias("q"))
    w = raw.select("query_id", parse_query("q").alias("words"))
    return w.select("query_id", F.size("words").alias("n_words"),
                    F.array_join("words", "|").alias("words"))


@register("search_any_candidates")
def search_any_candidates(spark, sf):
    c = srch.candidates(stored_index(spark, sf), passages(spark, sf))
    return c.select("query_id", "word", "book_id", join_ints("positions").alias("positions"))


@register("search_all_words")
def search_all_words(spark, sf):
    m = passage_matches(spark, sf)
    return m.select("query_id", "book_id", F.explode("positions").alias("word", "p")) \
        .select("query_id", "book_id", "word", join_ints("p").alias("positions"))


@register("search_intersect")
def search_intersect(spark, sf):
    """Two-word requests (every pair of consecutive distinct words of every passage)
    answered as the set intersection of the two per-word book sets."""
    p = passages(spark, sf).select(
        "query_id", F.posexplode(F.arrays_zip(
            F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))),
            F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))))).alias("i", "pair"))
    req = p.select(F.struct("query_id", F.col("i").alias("pair")).alias("query_id"),
                   F.array(F.col("pair")["0"], F.col("pair")["1"]).alias("words"))
    res = srch.intersect_two_words(stored_index(spark, sf), req)
    return res.select(F.col("query_id.query_id").alias("query_id"),
                      F.col("query_id.pair").alias("pair"), "book_id")


@register("search_result_map")
def search_result_map(spark, sf):
    return passage_matches(spark, sf).select(
        "query_id", "book_id", positions_text("positions").alias("positions"))


@register("flatten_positions")
def flatten_positions_q(spark, sf):
    m = passage_matches(spark, sf)
    return m.select("query_id", "book_id", join_ints(flatten_positions(
        F.transform(F.map_entries("positions"), lambda e: F.struct(
            e["key"].alias("word"), e["value"].alias("positions"))))).alias("positions"))


@register("search_title")
def search_title(spark, sf):
    return _criteria_search(spark, sf, title="e")


@register("search_author")
def search_author(spark, sf):
    return _criteria_search(spark, sf, author="SRC1")


@register("search_language")
def search_language(spark, sf):
    return _criteria_search(spark, sf, language="english")


@register("search_from")
def search_from(spark, sf):
    return _criteria_search(spark, sf, year_from="2000")


@register("search_to")
def search_to(spark, sf):
    return _criteria_search(spark, sf, year_to="2005")


@register("search_filtered")
def search_filtered(spark, sf):
    return _criteria_search(spark, sf, author="author src1", year_from="1998",
                            year_to="2012", language="E")


@register("search_batch")
def search_batch(spark, sf):
    req = fixtures.title_requests(documents(spark, sf))
    r = srch.search_batch(stored_index(spark, sf), req, stored_catalog(spark, sf))
    return r.select("query_id", "book_id", positions_text("positions").alias("positions"))


@register("criteria_books")
def criteria_books(spark, sf):
    """Title lookups through the n-gram index: the books whose title contains, whatever the case, the
    first two words of a ``benchmark`` passage; and every source's author."""
    items = spark.read.parquet(table_path(sf, "benchmark"))
    titles = items.select(F.lit("title").alias("field"),
                          F.regexp_extract("text", fixtures.FIRST_TWO_WORDS, 0).alias("criterion"))
    authors = documents(spark, sf).select(F.lit("author").alias("field"), F.col("source").alias("criterion"))
    return books_containing(stored_criteria(spark, sf), titles.unionByName(authors))


@register("search_json")
def search_json(spark, sf):
    return passage_matches(spark, sf).select("query_id", "book_id",
                                             result_json().alias("json"))


@register("fragment_stub")
def fragment_stub(spark, sf):
    from quire.constants import FRAGMENT_STUB
    m = passage_matches(spark, sf).select(
        "query_id", "book_id", F.explode("positions").alias("word", "p"))
    hits = m.select("query_id", "book_id", "word", F.explode("p").alias("pos"))
    return hits.select("query_id", "book_id", "word", "pos", F.format_string(
        FRAGMENT_STUB, F.col("pos"), F.col("book_id")).alias("fragment"))


@register("text_fragment")
def text_fragment(spark, sf):
    """Keyword in context: the 5 tokens before and after each hit of each word, from the forward index."""
    m = passage_matches(spark, sf).select(
        "query_id", "book_id", F.explode("positions").alias("word", "p"))
    hits = m.select("query_id", "book_id", "word", F.explode("p").alias("pos"))
    staged = work_path(spark, "hits")   # read twice below: for the places, and for the rows
    hits.write.parquet(staged)
    return fragments_of_hits(stored_forward(spark, sf), spark.read.schema(hits.schema).parquet(staged), radius=5)


# ---------------------------------------------------------------- extraction ------------

@register("strip_header")
def strip_header_q(spark, sf):
    return documents(spark, sf).select(F.col("doc_id").alias("book_id"),
                                       strip_header("text").alias("text"))


def _book_pages(spark, sf):
    return fixtures.book_pages(documents(spark, sf))


def _listing(spark, sf):
    return fixtures.listing_pages(documents(spark, sf))


@register("index_pages")
def index_pages(spark, sf):
    """The download-to-index flow over fetched web pages: body text of every page, the
    header cut at the first *** marker, then the positional index (page_id as book id)."""
    p = spark.read.parquet(table_path(sf, "pages")).select(
        F.col("page_id").alias("book_id"), strip_header(body_text("html")).alias("text"))
    return flat_postings(build_index(p))


@register("title_author")
def title_author(spark, sf):
    h = _book_pages(spark, sf).select("href", heading("html").alias("h"))
    return h.select("href", split_title("h").alias("title"), split_author("h").alias("author"))


@register("page_heading")
def page_heading(spark, sf):
    p = spark.read.parquet(table_path(sf, "pages"))
    return p.select("page_id", heading("html").alias("heading"))


@register("page_text")
def page_text(spark, sf):
    p = spark.read.parquet(table_path(sf, "pages"))
    return p.select("page_id", body_text("html").alias("text"))


@register("extract_links")
def extract_links(spark, sf):
    return crawling.extract_links(_listing(spark, sf))


@register("links_per_page")
def links_per_page(spark, sf):
    return crawling.links_per_page(_listing(spark, sf))


@register("extract_book_record")
def extract_book_record(spark, sf):
    return crawling.extract_book_records(_book_pages(spark, sf))


@register("release_date")
def release_date_q(spark, sf):
    return _book_pages(spark, sf).select("href", release_date("html").alias("release_date"))


@register("detect_language")
def detect_language(spark, sf):
    return _book_pages(spark, sf).select("href", language_cell("html").alias("language"))


@register("download_link")
def download_link_q(spark, sf):
    return _book_pages(spark, sf).select("href", download_link("html").alias("download"))


@register("absolute_url")
def absolute_url_q(spark, sf):
    d = _book_pages(spark, sf).select("href", download_link("html").alias("download"))
    return d.filter(F.col("download").isNotNull()).select(
        "href", absolute_url("download").alias("url"))


@register("link_book_id")
def link_book_id_q(spark, sf):
    links = crawling.extract_links(_listing(spark, sf))
    return links.select("href", link_book_id("href").alias("book_id"))


@register("crawl_frontier")
def crawl_frontier(spark, sf):
    return crawl.frontier_of(_listing(spark, sf))


@register("pending_pages")
def pending_pages(spark, sf):
    """Frontier minus the listing pages already fetched.  Stand-in ledger: a moderation
    crawl fetched every listing page that lists a book labelled toxic."""
    d = documents(spark, sf)
    toxic = spark.read.parquet(table_path(sf, "labels")).filter(F.col("toxic") == 1)
    fetched = fixtures.listing_pages(d.join(toxic, "doc_id", "left_semi")) \
        .select(F.col("start_index").alias("page"))
    return crawl.pending_pages(crawl.frontier_of(_listing(spark, sf)), fetched)


@register("claimed_pages")
def claimed_pages(spark, sf):
    """The frontier after two takers: ``a`` claims a third of the pages for a minute, ``b`` the next third
    half a minute later, and ``a`` fetches those pages that list a book labelled toxic.  Seventy seconds after the
    start the other pages of ``a`` are free again."""
    front = crawl.frontier_of(_listing(spark, sf))
    d = documents(spark, sf)
    toxic = spark.read.parquet(table_path(sf, "labels")).filter(F.col("toxic") == 1)
    fetched = fixtures.listing_pages(d.join(toxic, "doc_id", "left_semi")) \
        .select(F.col("start_index").alias("page"))
    log, third = work_path(spark, "claims"), front.count() // 3
    claim_pages(front, log, "a", third, lease=60, now=0)
    claim_pages(front, log, "b", third, lease=60, now=30)
    finish_pages(fetched, log, "a", now=50)
    state = claim_state(spark, log)
    marked = with_claims(front, state, now=70)
    return marked.join(state.select("page", "taker"), "page", "left").select("page", "claimed", "taker")

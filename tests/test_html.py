from pyspark.sql import functions as F

from support import rows
from quire.functions.html import (
    absolute_url, body_text, book_links, download_link, heading, language_cell,
    link_book_id, release_date, split_author, split_title,
)
from quire.plans.crawling import extract_book_records

PAGE = ('<html><body><h1>  A <i>by</i> B\n by   C &amp; D </h1><table><tr><td>Dutch</td>'
        '<td>English</td><td itemprop="datePublished">Jan 2, 1990</td>'
        '<td itemprop="datePublished"> Feb 3, 1991</td></tr></table>'
        '<a href="/ebooks/5.epub">EPUB</a><a href="/ebooks/5.txt">plain TEXT utf-8</a>'
        '<a href="/other">Plain Text UTF-8</a></body></html>')


def _one(spark, col, html=PAGE):
    return spark.createDataFrame([(html,)], "html STRING").select(col.alias("x")).first()["x"]


def test_heading_and_title_author(spark):
    h = _one(spark, heading("html"))
    assert h == "A by B by C & D"
    assert _one(spark, split_title(F.lit(h))) == "A by B"
    assert _one(spark, split_author(F.lit(h))) == "C & D"
    assert _one(spark, split_title(F.lit("No author here"))) == "Unknown"
    assert _one(spark, heading("html"), "<html><body><p>x</p></body></html>") is None


def test_release_date_language_download(spark):
    assert _one(spark, release_date("html")) == "Jan 2, 1990 Feb 3, 1991"
    assert _one(spark, release_date("html"), "<td>x</td>") == "Unknown"
    assert _one(spark, language_cell("html")) == "Dutch"
    assert _one(spark, language_cell("html"), "<td>english</td>") == "Unknown"
    assert _one(spark, download_link("html")) == "/ebooks/5.txt"
    assert _one(spark, download_link("html"), "<a href='x'>EPUB</a>") is None


def test_urls_and_ids(spark):
    assert _one(spark, absolute_url(F.lit("/ebooks/1.txt"))) == "https://www.gutenberg.org/ebooks/1.txt"
    assert _one(spark, absolute_url(F.lit("http://x/y"))) == "http://x/y"
    assert _one(spark, link_book_id(F.lit("/ebooks/123"))) == "123"
    assert _one(spark, link_book_id(F.lit("/ebooks/"))) is None
    assert _one(spark, link_book_id(F.lit("/ebooks"))) is None


def test_book_links_only_booklink_items(spark):
    html = ('<a href="/ebooks/1">out</a><ul><li class="booklink"><a href="/ebooks/2">b</a></li>'
            '<li class="other"><a href="/ebooks/3">c</a></li>'
            '<li class="x booklink"><a href="/ebooks/4">d</a><a href="/elsewhere/5">e</a></li></ul>')
    assert _one(spark, book_links("html"), html) == ["/ebooks/2", "/ebooks/4"]


def test_body_text_keeps_whitespace(spark):
    html = ('<html><head><title>T</title></head><body><script>var a="<b>";</script>'
            '<p>one&amp;two</p><!-- c --><br>three  four</body></html>')
    assert _one(spark, body_text("html"), html) == "one&two\nthree  four"


def test_book_records_drop_incomplete_pages(spark):
    pages = spark.createDataFrame([
        ("/ebooks/5", PAGE), ("/ebooks/6", "<h1>X by Y</h1>"),
        ("/ebooks/7", "<p>no heading</p><a href='/a'>Plain Text UTF-8</a>"),
        ("/ebooks/", PAGE)], "href STRING, html STRING")
    recs = rows(extract_book_records(pages), "book_id", "title", "author", "download_url")
    assert recs == [("5", "A by B", "C & D", "https://www.gutenberg.org/ebooks/5.txt")]


def test_single_quoted_attributes(spark):
    html = ("<li class='booklink'><a href='/ebooks/9'>x</a></li>"
            "<td itemprop='datePublished'>May 1, 2001</td>"
            "<a href = '/ebooks/9.txt'>Plain Text UTF-8</a>")
    assert _one(spark, book_links("html"), html) == ["/ebooks/9"]
    assert _one(spark, release_date("html"), html) == "May 1, 2001"
    assert _one(spark, download_link("html"), html) == "/ebooks/9.txt"


def test_hrefs_are_decoded(spark):
    html = ('<li class="booklink"><a href="/ebooks/1?a=1&amp;b=2">x</a></li>'
            '<a href="/files/1.txt?x=1&amp;y=2">Plain Text UTF-8</a>')
    assert _one(spark, book_links("html"), html) == ["/ebooks/1?a=1&b=2"]
    assert _one(spark, download_link("html"), html) == "/files/1.txt?x=1&y=2"


def test_character_references(spark):
    html = ("<body>caf&eacute; it&#8217;s &#x1F600; &amp;lt; &lt;b&gt; &nosuch; AT&T &; &#0; &#xD800; "
            "&#9999999; &apos;&Alpha;&alpha;</body>")
    assert _one(spark, body_text("html"), html) == (
        "caf\u00e9 it\u2019s \U0001F600 &lt; <b> &nosuch; AT&T &; \ufffd \ufffd \ufffd '\u0391\u03b1")
    assert _one(spark, heading("html"), "<h1>Caf&eacute;&nbsp; &#8212; x</h1>") == "Caf\u00e9 \u2014 x"


def test_messy_pages(spark):
    assert _one(spark, body_text("html"), "<p>no body</p> here") == "no body here"
    assert _one(spark, body_text("html"), "<head><title>t</title></head><p>x") == "x"
    assert _one(spark, body_text("html"), "<html><body class=a>open <b>end") == "open end"
    assert _one(spark, body_text("html"), "<body>cut <script>var x = 1") == "cut "
    assert _one(spark, body_text("html"), "<body>cut <!-- <p>x") == "cut "
    assert _one(spark, body_text("html"), "<body>1 < 2 <a href='/x") == "1 < 2 "
    assert _one(spark, body_text("html"), "") == ""
    assert _one(spark, body_text("html"), None) is None
    assert _one(spark, heading("html"), "<h1>open heading") == "open heading"
    html = "<ul><li class=booklink><a href=/ebooks/5>x</a><li class=booklink><a class=c href='/ebooks/6'>y</a></ul>"
    assert _one(spark, book_links("html"), html) == ["/ebooks/5", "/ebooks/6"]
    assert _one(spark, download_link("html"), "<a href=/f/5.txt>Plain Text UTF-8</a>") == "/f/5.txt"

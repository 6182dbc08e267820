"""HTML extraction expressions for crawled pages (headings, table cells, anchors, body text).

Everything is regular expressions and string functions, so extraction runs inside the
scan stage.  Pages need not be well formed: a missing ``body`` or an unclosed heading takes
the rest of the page, and attribute values may go without quotes.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.constants import (
    BASE_URL, BOOK_LINK_PREFIX, DOWNLOAD_ANCHOR_TEXT, LANGUAGES, TITLE_AUTHOR, UNKNOWN,
)

# element patterns (Java regex)
# Tags whose boundaries separate words in element text.
BLOCK_TAGS = (r"(?i)</?(br|p|div|li|ul|ol|h[1-6]|table|tr|td|th|article|section|nav|"
               r"header|footer|blockquote|pre)\b[^>]*>")
ANY_TAG = r"<[^>]*>"
CUT_TAG = r"<[A-Za-z/!][^>]*\z"    # a page that ends inside a tag
HIDDEN = r"(?is)<script\b.*?(?:</script>|\z)|<style\b.*?(?:</style>|\z)|<!--.*?(?:-->|\z)"
TEXT_WS = "[ \\t\\n\\f\\r\u00a0]+"  # jsoup whitespace, incl. no-break space

H1 = r"(?is)<h1\b[^>]*>(.*?)(?:</h1>|\z)"
DATE_CELL = r"""(?is)<td\b[^>]*itemprop=["']?datePublished["']?[^>]*>(.*?)</td>"""
CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a>"
HREF = r"""(?is)\bhref\s*=\s*["']?((?<=["'])[^"']*|(?<!["'])[^\s"'>]+)"""
BOOKLINK_ITEM = (r"""(?is)<li\b[^>]*class\s*=\s*(?:["'](?:[^"']*\s)?booklink(?:\s[^"']*)?["']"""
                 r"""|booklink(?=[\s>]))[^>]*>(.*?)(?:</li>|(?=<li\b)|\z)""")
BOOKLINK_HREF = (r"""(?is)<a\b[^>]*\bhref\s*=\s*["']?"""
                 r"""((?<=["'])/ebooks/[^"']*|(?<!["'])/ebooks/[^\s"'>]*)""")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bound(c: Column, use) -> Column:
    """``use(c)`` with ``c`` computed once, however often ``use`` reads it: the optimizer
    copies a plain expression to every place that reads it, but not a lambda's argument."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


#: code points of named references, from Python's own table, and the one name it lacks
NAMED = {**name2codepoint, "apos": 39}
REFERENCE = r"(?s)^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _referred(name: Column) -> Column:
    """Character of a reference (the part between & and ;); NULL for an unknown name."""
    hexed = F.lower(F.substring(name, 2, 1)) == "x"
    point = F.when(name.startswith("#"), F.when(
        hexed, F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2))).cast("int")).otherwise(
        F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])[name])
    valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    shown = F.when(valid, point).when(point.isNotNull(), F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(shown), 8, "0")), "UTF-32")


def decode_entities(c) -> Column:
    """Named and numeric character references decoded in one pass, so ``&amp;lt;`` gives
    ``&lt;``.  Unknown names stay; numbers that are no character give U+FFFD."""
    def replaced(p: Column, name: Column) -> Column:
        char = F.when(name != "", _referred(name))
        return F.coalesce(F.concat(char, F.substr(p, F.length(name) + 2)), F.concat(F.lit("&"), p))

    def part(p: Column, i: Column) -> Column:
        return F.when(i == 0, p).otherwise(_bound(F.regexp_extract(p, REFERENCE, 1), lambda name: replaced(p, name)))

    return _bound(_col(c), lambda t: F.when(
        t.contains("&"), F.array_join(F.transform(F.split(t, "&"), part), "")).otherwise(t))


def html_text(fragment) -> Column:
    """Normalized text of an HTML fragment: tags removed (block tags separate words),
    character references decoded, whitespace runs collapsed to one space, trimmed."""
    t = F.regexp_replace(_col(fragment), BLOCK_TAGS, " ")
    t = F.regexp_replace(t, ANY_TAG, "")
    t = decode_entities(t)
    return F.trim(F.regexp_replace(t, TEXT_WS, " "))


def heading(html) -> Column:
    """Text of the first ``h1``; NULL when the page has none (the book is skipped)."""
    html = _col(html)
    return F.when(html.rlike(r"(?is)<h1\b"), html_text(F.regexp_extract(html, H1, 1)))


def split_title(heading_text) -> Column:
    """Title of ``TITLE by AUTHOR`` (the last " by " splits); 'Unknown' without " by "."""
    h = _col(heading_text)
    return F.when(h.rlike(TITLE_AUTHOR), F.trim(F.regexp_extract(h, TITLE_AUTHOR, 1))) \
        .otherwise(F.lit(UNKNOWN))


def split_author(heading_text) -> Column:
    h = _col(heading_text)
    return F.when(h.rlike(TITLE_AUTHOR), F.trim(F.regexp_extract(h, TITLE_AUTHOR, 2))) \
        .otherwise(F.lit(UNKNOWN))


def release_date(html) -> Column:
    """Texts of all ``td[itemprop=datePublished]`` joined by a space; 'Unknown' if empty."""
    cells = F.transform(F.regexp_extract_all(_col(html), F.lit(DATE_CELL), 1), html_text)
    return _bound(F.trim(F.array_join(cells, " ")),
                  lambda t: F.when(t == "", F.lit(UNKNOWN)).otherwise(t))


def language_cell(html) -> Column:
    """First ``td`` whose whole text is one of the known language names, else 'Unknown'."""
    cells = F.transform(F.regexp_extract_all(_col(html), F.lit(CELL), 1), html_text)
    known = F.filter(cells, lambda t: t.isin(*LANGUAGES))
    return F.coalesce(F.get(known, 0), F.lit(UNKNOWN))


def download_link(html) -> Column:
    """href (character references decoded) of the first anchor whose text contains
    'Plain Text UTF-8' (any case); NULL if there is none (the book is then dropped)."""
    anchors = F.regexp_extract_all(_col(html), F.lit(ANCHOR), 0)
    plain = F.filter(anchors, lambda a: F.lower(
        html_text(F.regexp_extract(a, ANCHOR, 2))).contains(DOWNLOAD_ANCHOR_TEXT))
    return F.get(F.transform(F.slice(plain, 1, 1), lambda a: decode_entities(F.regexp_extract(a, HREF, 1))), 0)


def absolute_url(href, base: str = BASE_URL) -> Column:
    """Prefix the site root unless the link already starts with 'http'."""
    href = _col(href)
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def link_book_id(href) -> Column:
    """Third '/'-separated part of a book link (``/ebooks/123`` -> '123'); NULL when the
    link is too short (the reference fails on it and skips the book)."""
    return F.nullif(F.get(F.split(_col(href), "/"), 2), F.lit(""))


def book_links(html) -> Column:
    """ARRAY of hrefs (references decoded) of ``li.booklink a[href^='/ebooks/']`` in
    document order."""
    items = F.regexp_extract_all(_col(html), F.lit(BOOKLINK_ITEM), 1)
    return F.transform(F.flatten(F.transform(items, lambda i: F.regexp_extract_all(
        i, F.lit(BOOKLINK_HREF), 1))), decode_entities)


def body_text(html) -> Column:
    """Whole text of ``body``, or of the page after its ``head`` where ``body`` is missing, to
    the end of the page where nothing closes it: scripts, styles and comments dropped, ``br`` as a newline, tags removed, character
    references decoded, whitespace kept as it is."""
    html = _col(html)
    opened = F.when(html.rlike(r"(?i)<body\b"), F.regexp_replace(html, r"(?is)\A.*?<body\b[^>]*>", "")) \
        .otherwise(F.regexp_replace(html, r"(?is)<head\b.*?</head>", ""))
    body = _bound(opened, lambda t: F.when(
        t.rlike(r"(?i)</body>"), F.regexp_extract(t, r"(?is)\A(.*)</body>", 1)).otherwise(t))
    body = F.regexp_replace(body, HIDDEN, "")
    body = F.regexp_replace(body, r"(?i)<br\b[^>]*>", "\n")
    return decode_entities(F.regexp_replace(body, ANY_TAG + "|" + CUT_TAG, ""))


assert BOOK_LINK_PREFIX in BOOKLINK_HREF

"""Text expressions: the default tokenizer, header stripping, book keys and query parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.constants import HEADER_MARKER, JAVA_WHITESPACE, TOKEN_BREAK_CHARS

# Java's String.trim removes every char <= U+0020 at both ends; Spark's trim only spaces.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """Default tokenizer: ARRAY<STRING> of the words of ``text`` in reading order.

    Lower-case, every character of the break class becomes one space, split on runs of
    (Java) whitespace, drop empty strings.  Stopwords are kept here: positions count them.
    Tokenizing the whole text at once equals tokenizing it line by line, because line
    breaks are whitespace for the split.

    The break class and the whitespace are fixed character sets, so one ``translate``
    maps them all to a space and the split is on a single space (no regex engine); the
    empty strings between consecutive spaces are dropped by the filter.
    """
    breaks = TOKEN_BREAK_CHARS + JAVA_WHITESPACE
    cleaned = F.translate(F.lower(_col(text)), breaks, " " * len(breaks))
    return F.filter(F.split(cleaned, " "), lambda w: w != F.lit(""))


def java_trim(c) -> Column:
    return F.regexp_replace(_col(c), _JAVA_TRIM, "")


def strip_header(text) -> Column:
    """Drop everything up to the end of the first ``***...***`` marker, then trim.

    A text without a marker is returned unchanged (and untrimmed); the footer is kept.
    The marker must open and close on one line.
    """
    parts = F.split(_col(text), HEADER_MARKER, 2)
    return F.when(F.size(parts) == 2, java_trim(F.get(parts, 1))).otherwise(_col(text))


def normalize_separators(path) -> Column:
    return F.translate(_col(path), "\\", "/")


def doc_key_from_path(path) -> Column:
    """ASCII digits of the base name of a path; '' when the name has none."""
    base = F.try_element_at(F.split(normalize_separators(path), "/"), F.lit(-1))
    return F.regexp_replace(base, r"[^0-9]", "")


def book_id_from_path(path) -> Column:
    """Integer book id from the digits of the file name; NULL when empty or too large.

    ``007.txt`` and ``7.txt`` both give book 7 (their ledger keys differ).  Widened to
    BIGINT so file-based and table-based books share one schema.
    """
    return doc_key_from_path(path).try_cast("int").cast("bigint")


def parse_query(q) -> Column:
    """Split a ``w1+w2+...`` request into words like Java's ``split("\\+")``.

    Trailing empty strings are removed, inner and leading ones kept (an empty word never
    matches).  No lower-casing, no trimming.  An empty request is one empty word; a
    request of only ``+`` signs has no words.
    """
    q = _col(q)
    stripped = F.regexp_replace(q, r"\++$", "")
    return (F.when(q == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, r"\+")))

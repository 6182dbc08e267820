"""Metadata-line expressions: format (crawler side), parse (query side), release year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.constants import METADATA_PAIR, METADATA_TEMPLATE, MONTHS, MONTHS_SHORT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_metadata_line(book_id, title, author, date, language) -> Column:
    """``ID: …, Title: …, Author: …, Release Date: …, Language: …`` — no escaping, so a
    comma or colon inside a value changes how the line parses back."""
    return F.format_string(METADATA_TEMPLATE, *[_col(c) for c in
                                                (book_id, title, author, date, language)])


def metadata_pairs(line) -> Column:
    """ARRAY<STRUCT<k, v>> of every ``Key: value`` match of the line, in order.  Compute
    it once (one projection) and pass it to the functions below with ``pairs=``."""
    keys = F.regexp_extract_all(_col(line), F.lit(METADATA_PAIR), 1)
    values = F.regexp_extract_all(_col(line), F.lit(METADATA_PAIR), 2)
    return F.arrays_zip(keys.alias("k"), values.alias("v"))


def _pairs_of(line, pairs) -> Column:
    return metadata_pairs(line) if pairs is None else _col(pairs)


def metadata_field(line, key: str, pairs=None) -> Column:
    """Value of ``key`` in the line (the last one when the key repeats); NULL if absent."""
    hits = F.filter(_pairs_of(line, pairs), lambda p: p["k"] == F.lit(key))
    return F.try_element_at(hits, F.lit(-1))["v"]


def metadata_id(line, pairs=None) -> Column:
    """Book id of the line as INT: the last ``ID`` value when it is an integer literal,
    -1 when the line has no ``ID``, NULL when the value is not an integer (set aside)."""
    v = metadata_field(line, "ID", pairs)
    parsed = F.when(v.rlike(r"^[+-]?[0-9]+$"), v.try_cast("int"))
    return F.when(v.isNull(), F.lit(-1)).otherwise(parsed)


def metadata_fields(line, pairs=None) -> Column:
    """MAP<STRING,STRING> of every key except ``ID``; a repeated key keeps its last value.

    Duplicates are resolved with array functions, so the session's map-key policy does
    not matter.
    """
    pairs = F.filter(_pairs_of(line, pairs), lambda p: p["k"] != F.lit("ID"))
    keys = F.transform(pairs, lambda p: p["k"])
    last = F.filter(pairs, lambda p, i: ~F.array_contains(
        F.slice(keys, i + 2, F.greatest(F.size(keys) - i - 1, F.lit(0))), p["k"]))
    return F.map_from_entries(last)


def _month_number(name: Column) -> Column:
    lowered = F.lower(name)
    full = F.array(*[F.lit(m.lower()) for m in MONTHS])
    short = F.array(*[F.lit(m.lower()) for m in MONTHS_SHORT])
    n = F.greatest(F.array_position(full, lowered), F.array_position(short, lowered))
    return F.when(n > 0, n)


def release_year(date_text) -> Column:
    """Year of a ``MMM d, yyyy`` date with lenient parsing; NULL when unparseable.

    Month names match full or abbreviated, in any case; the day may overflow into the
    next months ("Feb 31, 2000" is in March); text after the year is ignored.
    """
    pattern = r"^[ \t]*([A-Za-z]+)\s+[ \t]*(\d{1,2}),\s+[ \t]*(\d{1,4})"
    d = _col(date_text)
    month = _month_number(F.regexp_extract(d, pattern, 1))
    day = F.regexp_extract(d, pattern, 2).try_cast("int")
    year = F.regexp_extract(d, pattern, 3).try_cast("int")
    ok = d.rlike(pattern) & month.isNotNull() & (year >= 1)
    first = F.make_date(year, month, F.lit(1))
    return F.when(ok, F.year(F.date_add(first, day - 1)))

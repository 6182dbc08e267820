"""Forward index: the tokens of a book in blocks, so that a fragment reads a block, not a book.

``cell`` is a hash of (book_id, block) and nothing but a place: a stored forward index is bucketed
by it (see quire.sinks.forward_store), so a very long book, or an id delivered in many copies, lies in
many buckets, and a literal place opens one of them.  Joins compare book_id and block as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import tokenize

BLOCK = 512   # tokens a block
FORWARD_SCHEMA = "cell BIGINT, book_id BIGINT, block INT, version STRING, tokens ARRAY<STRING>"


def cell_of(book_id: Column, block: Column) -> Column:
    return F.xxhash64(book_id.cast("bigint"), block.cast("int"))


def token_blocks(books: DataFrame, tokenizer=tokenize, block: int = BLOCK) -> DataFrame:
    """(cell, book_id, block, version, tokens): every ``block`` tokens of every book of (book_id, text).

    ``version`` is the digest of the text: different texts under one id stay apart, equal copies
    are one.  Null or empty texts, and texts without a token, have no block."""
    tokens = books.filter(F.col("book_id").isNotNull() & F.col("text").isNotNull()).select(
        "book_id", F.md5("text").alias("version"), tokenizer(F.col("text")).alias("t")).filter(F.size("t") > 0)
    cut = tokens.select("book_id", "version", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.floor((F.size("t") - 1) / block).cast("int")),
        lambda i: F.slice("t", i * block + 1, block))).alias("block", "tokens"))
    return cut.select(cell_of(F.col("book_id"), F.col("block")).alias("cell"), "book_id", "block", "version", "tokens")


def fragments(forward: DataFrame, places: DataFrame, radius: int = 5, block: int = BLOCK) -> DataFrame:
    """(book_id, pos, fragment) of distinct places (book_id, pos): the tokens from ``pos - radius``
    to ``pos + radius`` joined by spaces.

    A place asks for the one or few blocks it touches; their pieces meet again per place, at most
    2 * radius + 1 tokens of them.  A position outside the book gives no row; an id with several
    texts gives one row for each text that has the position."""
    start, end = F.greatest(F.col("pos") - radius, F.lit(0)), F.col("pos") + radius
    nth = lambda c: F.floor(c / block).cast("int")
    asked = places.filter(F.col("book_id").isNotNull() & (F.col("pos") >= 0)).select(
        "book_id", "pos", F.explode(F.sequence(nth(start), nth(end))).alias("block"))
    found = asked.withColumn("cell", cell_of(F.col("book_id"), F.col("block"))) \
        .join(forward, ["cell", "book_id", "block"])
    offset = F.col("block") * block
    first = F.greatest(start - offset, F.lit(0))
    piece = F.slice("tokens", first + 1, F.least(end - offset, F.lit(block - 1)) - first + 1)
    here = (nth(F.col("pos")) == F.col("block")) & (F.col("pos") - offset < F.size("tokens"))
    return (found.select("book_id", "pos", "version", "block", piece.alias("piece"), here.alias("here"))
            .groupBy("book_id", "pos", "version")
            .agg(F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("pieces"), F.max("here").alias("here"))
            .filter("here").select("book_id", "pos", F.array_join(F.flatten("pieces.piece"), " ").alias("fragment")))


def fragments_of_hits(forward: DataFrame, hits: DataFrame, radius: int = 5, block: int = BLOCK) -> DataFrame:
    """The rows of ``hits`` (..., book_id, pos) with the ``fragment`` around their place; each place
    is cut once, however many hits share it.  No text is tokenized and no block is exchanged."""
    cut = fragments(forward, hits.select("book_id", "pos").distinct(), radius, block)
    return hits.join(cut, ["book_id", "pos"]).select(*hits.columns, "fragment")

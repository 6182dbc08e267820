"""Block bitmaps: which books of a block of 256 consecutive ids hold a word.

A row is (word, block, part, m0..m3): four 64-bit masks, one bit a book.  Conjunctions are a
``bit_and`` of masks, so work follows blocks and not postings.  A frequent word is many rows, one a
block that holds it; ``part`` deals its blocks over a stored number of parts, so a table
bucketed by (word, part) spreads it over that many buckets and is joined without being moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 8
LANES = ("m0", "m1", "m2", "m3")
#: blocks of one word in one part, at most
PART_BLOCKS = 1 << 16

BLOCKS_SCHEMA = "word STRING, part INT, block BIGINT, m0 BIGINT, m1 BIGINT, m2 BIGINT, m3 BIGINT"


def parts_for(first_book: int, last_book: int) -> int:
    """Parts that keep a word's blocks in a part under ``PART_BLOCKS``."""
    return -(-((last_book >> BLOCK_BITS) - (first_book >> BLOCK_BITS) + 1) // PART_BLOCKS)


def part_of(block: Column, parts: int) -> Column:
    return F.pmod(block, F.lit(parts)).cast("int")


def word_blocks(postings: DataFrame, parts: int = 1, buckets: int | None = None) -> DataFrame:
    """Bitmaps of (word, book_id) rows; masks of one task are united before the exchange.

    With ``buckets`` the narrow rows are dealt by (word, part) first, and the bitmaps made where they
    stay: for postings whose books are dealt over the tasks, where a task has few books of a block."""
    if buckets is not None:
        postings = postings.select("word", "book_id").repartition(
            buckets, "word", part_of(F.shiftright(F.col("book_id").cast("bigint"), BLOCK_BITS), parts))
    book = F.col("book_id").cast("bigint")
    lane, bit = F.shiftright(book, 6).bitwiseAND(F.lit(3)), book.bitwiseAND(F.lit(63)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    block = F.shiftright(book, BLOCK_BITS)
    keyed = postings.select("word", part_of(block, parts).alias("part"), block.alias("block"),
                            *[F.when(lane == i, mask).otherwise(F.lit(0).cast("bigint")).alias(m) for i, m in enumerate(LANES)])
    return keyed.groupBy("word", "part", "block").agg(*[F.bit_or(m).alias(m) for m in LANES])


def not_empty() -> Column:
    out = F.col(LANES[0])
    for m in LANES[1:]:
        out = out.bitwiseOR(F.col(m))
    return out != 0


def books_of(blocks: DataFrame, *keep: str) -> DataFrame:
    """(keep..., book_id): one row a set bit."""
    lanes = F.explode(F.array(*[F.struct(F.lit(i).alias("lane"), F.col(m).alias("mask")) for i, m in enumerate(LANES)]))
    each = blocks.select(*keep, "block", lanes.alias("l")).filter(F.col("l.mask") != 0)
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)),
                    lambda i: F.call_function("shiftrightunsigned", F.col("l.mask"), i).bitwiseAND(F.lit(1)) == 1)
    each = each.select(*keep, "block", F.col("l.lane").alias("lane"), F.explode(bits).alias("bit"))
    return each.select(*keep, (F.call_function("shiftleft", F.col("block"), F.lit(BLOCK_BITS)) + F.col("lane") * 64 + F.col("bit")).alias("book_id"))


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, n_books) from the bitmaps."""
    bits = sum((F.bit_count(m) for m in LANES[1:]), F.bit_count(LANES[0]))
    return blocks.groupBy("word").agg(F.sum(bits).cast("bigint").alias("n_books"))

"""Benchmark decontamination: broadcast hash set of normalised test n-grams (native).

Every benchmark item gives its windows of 13 consecutive normalised words (an item of
fewer, but not none, is one window).  The first words of a window are its seed, and seed
hashes are the keys of a broadcast hash table.  One scan of the documents hashes the words
at every position, probes the table, and verifies each hit by comparing the words of the
whole window.  Only DataFrame functions run: no Python on the executors.

The broadcast is bounded: windows are counted and weighed first and cut into as many slices as
keep each broadcast under ``max_broadcast_bytes``; every slice is one more scan, nothing is dropped.

Words are runs of ASCII letters and digits and of all characters from U+0080 on, with A-Z
lower-cased.  Null and empty texts have no words, are never contaminated and keep one row.
Repeated documents are judged one by one; repeated or equal items all count.  An item with a
null id removes words but is not listed.  Empty tables give no rows or no hits.  Only the
named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import identified, without

#: fixed by the contract of the operator
WINDOW = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SEED_WORDS = 3
MAX_BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """Normalised words; an empty array for null."""
    # the JVM's lower() is fast and the same for texts of one byte a character
    ascii_lower = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(ascii_lower, F.lit("")), SEPARATORS), "")


def _seed(array: Column, at: Column, n: int) -> Column:
    """Hash of the ``n`` words that start at the zero-based position ``at``; null beyond the end."""
    return F.when(at + n <= F.size(array), F.xxhash64(*[F.get(array, at + i) for i in range(n)]))


def benchmark_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, window, len, n, seed): the windows of every item; n words are hashed as seed."""
    w = items.select(F.col(key).alias("item"), words(F.col(text).cast("string")).alias("w")).filter(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))))
    cut = (w.select("item", "w", at.alias("at"))
           .select("item", F.slice("w", F.col("at") + 1, F.lit(window)).alias("window")).distinct())
    cut = cut.withColumn("len", F.size("window")).withColumn("n", F.least("len", F.lit(SEED_WORDS)))
    seed = F.coalesce(*[F.when(F.col("n") == n, _seed(F.col("window"), F.lit(0), n)) for n in range(1, SEED_WORDS + 1)])
    return cut.withColumn("seed", seed)


def _covered(hits: Column) -> Column:
    """Positions covered by (start, end) ranges sorted by start."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        hits, zero,
        lambda acc, h: F.struct(
            (acc["n"] + F.greatest(F.lit(0), h["upto"] - F.greatest(h["start"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], h["upto"]).alias("upto")),
        lambda acc: acc["n"])


def _probe(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row a document (at its first position) and one a verified hit."""
    seeds = [F.struct(F.lit(n).alias("n"), _seed(F.col("w"), F.col("at"), n).alias("seed")) for n in lengths]
    places = docs.select("row", "id", "w", F.explode(F.sequence(F.lit(0), F.size("w"))).alias("at"))
    if len(seeds) == 1:
        places = places.select("*", F.lit(lengths[0]).alias("n"), _seed(F.col("w"), F.col("at"), lengths[0]).alias("seed"))
    else:
        places = places.select("*", F.explode(F.array(*seeds)).alias("s")).select("row", "id", "w", "at", "s.n", "s.seed")
    table = F.broadcast(windows.select(F.col("seed").alias("seed_"), F.col("n").alias("n_"), "item", "window", "len"))
    joined = places.join(table, (F.col("seed") == F.col("seed_")) & (F.col("n") == F.col("n_")), "left")
    hit = F.col("window").isNotNull() & (F.slice("w", F.col("at") + 1, F.col("len")) == F.col("window"))
    return joined.filter(hit | (F.col("at") == 0)).select(
        "row", "id", F.size("w").cast("bigint").alias("n_words"),
        F.when(hit, F.struct(F.col("at").alias("start"), (F.col("at") + F.col("len")).alias("upto"))).alias("hit"),
        F.when(hit, F.col("item")).alias("item"))


def find_hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
              item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
              max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(row, key, n_words, n_hit, ranges, items): one row per document row.

    ``ranges`` are the hit word ranges (start, upto) in order, ``items`` the distinct items
    found.  ``row`` tells repeated documents apart."""
    windows = benchmark_windows(items, item_key, item_text, window)
    stats = windows.agg(F.sum(F.size("window") * 16 + F.octet_length(F.array_join("window", "")) + 96),
                        F.collect_set("n")).first()
    lengths = sorted(stats[1]) or [SEED_WORDS]
    n_slices = max(1, -(-int(stats[0] or 0) // max_broadcast_bytes))
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"),
                       words(F.col(text).cast("string")).alias("w"))
    found = None
    for i in range(n_slices):
        part = windows if n_slices == 1 else windows.filter(F.pmod(F.xxhash64("window"), F.lit(n_slices)) == i)
        probe = _probe(base, part, lengths)
        found = probe if found is None else found.union(probe)
    grouped = found.groupBy("row", "id", "n_words").agg(
        F.array_sort(F.collect_set("hit")).alias("ranges"), F.collect_set("item").alias("items"))
    return grouped.select("row", F.col("id").alias(key), "n_words", _covered(F.col("ranges")).alias("n_hit"),
                          "ranges", "items")


def contamination(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract's columns from ``find_hits``."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return hits.select(
        key, "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated_rows(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows that are not contaminated, all columns kept; each is judged by itself and ids are not read."""
    rows, row = identified(docs, "numbered-documents")
    bad = contamination(find_hits(rows, items, row, text, **options), row).filter("contaminated").select(row)
    return without(rows, row, bad).drop(row)


def _outside(w: Column, ranges: Column) -> Column:
    """The words between ranges (start, upto) sorted by start, in order."""
    gap = "array<struct<start:int,upto:int>>"
    start = F.struct(F.lit(0).alias("upto"), F.array().cast(gap).alias("gaps"))
    step = lambda acc, r: F.struct(
        F.greatest(acc["upto"], r["upto"]).alias("upto"),
        F.when(r["start"] > acc["upto"], F.concat(acc["gaps"], F.array(F.struct(acc["upto"].alias("start"), r["start"].alias("upto"))).cast(gap)))
        .otherwise(acc["gaps"]).alias("gaps"))
    gaps = F.aggregate(ranges, start, step, lambda acc: F.concat(acc["gaps"], F.array(F.struct(acc["upto"].alias("start"), F.size(w).alias("upto"))).cast(gap)))
    return F.flatten(F.transform(gaps, lambda g: F.slice(w, g["start"] + 1, g["upto"] - g["start"])))


def remove_hit_words(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, text): normalised words of each row without its own hit ranges, joined by spaces.

    Every row is judged by itself, whatever its id; one row per input row."""
    rows, row = identified(docs.select(key, text), "numbered-documents")
    spans = find_hits(rows, items, row, text, **options).filter("n_hit > 0").select(row, "ranges")
    w = rows.select(row, key, words(F.col(text).cast("string")).alias("w_")).join(spans, row, "left")
    kept = F.when(F.col("ranges").isNull(), F.col("w_")).otherwise(_outside(F.col("w_"), F.col("ranges")))
    return w.select(key, F.array_join(kept, " ").alias("text"))

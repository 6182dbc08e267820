"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are the bitwise majority of the XXH64 hashes of a text's word shingles.  For
radius r every bit position gets a non-zero vector of r + 1 bits, and there is one hash
table for each non-zero vector v, keyed by the fingerprint bits whose vector has an odd
product with v.  Any r vectors have a common orthogonal v, so two fingerprints that differ
in at most r bits agree on all keyed bits of at least one table: no link is missed.
(R. Pagh, "Locality-sensitive Hashing without False Negatives", 2016.)

Equal fingerprints are collapsed before the tables are built, so exact copies never meet as
pairs.  A bucket of many different fingerprints is cut by further bits (again so that linked
fingerprints share a piece), and a bucket gives a spanning forest of its links, not all
pairs: reachability is kept and rows stay linear.

Null, empty and blank texts have no words and fingerprint 0, which links like any other.  A
text with fewer words than the shingle length is one shingle.  Rows may repeat; rows of one id
are linked by their fingerprints only.  Rows with a null id link others as any row does; their
component is null if no id of the group is known.  Long texts are hashed in pieces.  An empty table gives no rows.  Only ``key`` and ``text`` are read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quire.llm.common import identified, slices, staged, without
from quire.llm.components import components

BITS = 64
SEED = 42
#: different fingerprints compared in one bucket; a larger bucket is cut by further bits
BUCKET = 2048
#: shingles hashed at a time, so memory does not follow the length of a text
PIECE = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64-bit SimHash of one text (UTF-8)."""
    words = text.lower().split() if text else []     # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes + 1) - 1
    begin = end - sizes
    shingle = min(shingle, len(words))
    begin, end = begin[:len(words) - shingle + 1], end[shingle - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(begin), PIECE):
        pieces = [joined[i:j] for i, j in zip(begin[at:at + PIECE].tolist(), end[at:at + PIECE].tolist())]
        hashes = np.fromiter(map(xxh64_intdigest, pieces, repeat(SEED)), "<u8", len(pieces))
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp): fp is the fingerprint as a signed long, one row per input row."""
    def hashed(batches):
        for part, texts in slices(batches, "text"):
            prints = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(prints.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(hashed, f"id {kind}, fp bigint").withColumnRenamed("id", key)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask a table: every set of ``radius`` bit positions is outside some mask."""
    top = 1 << (radius + 1)
    vector = [1 + i % (top - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, top)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _blocks(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` dealt into ``parts`` masks."""
    at = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << i for i in at[p::parts]) for p in range(parts)]


def forest(prints: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the links among different fingerprints."""
    left, right, rest = [], [], prints
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                left += [int(x)] * len(found)
                right += found.tolist()
                queue += list(found)
                rest = rest[~near]
    return left, right


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    def linked(batches):
        for batch in batches:
            left, right = [], []
            for row in batch.column("prints"):
                found = forest(row.values.to_numpy(zero_copy_only=False).view(np.uint64), radius)
                left += found[0]
                right += found[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(left, np.uint64).view(np.int64)), pa.array(np.array(right, np.uint64).view(np.int64))],
                ["a", "b"])

    return buckets.select("prints").mapInArrow(linked, "a bigint, b bigint")


def links(prints: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between different fingerprints that keep every component whole.

    ``prints`` holds distinct fingerprints in column ``fp``."""
    masks = covering_masks(radius)
    tables = [(t, m) for t, m in enumerate(masks)]
    level = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")).alias("k"))
        for t, m in tables])).alias("x")).select("fp", "x.t", "x.k")
    found = None
    for depth in range(3):
        sizes = level.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1")
        full = level.join(sizes, ["t", "k"])
        fits = full if depth == 2 else full.filter(F.col("n") <= bucket)
        here = _bucket_links(fits.groupBy("t", "k").agg(F.collect_list("fp").alias("prints")), radius)
        found = here if found is None else found.union(here)
        if depth == 2:
            return found.distinct()
        # keep the bits of the key and add one block of the others: links share some block
        finer, choices = [], []
        for t, m in tables:
            for block in _blocks(~m & ((1 << BITS) - 1), radius + 1):
                choices.append((t, len(finer), m | block))
                finer.append((len(finer), m | block))
        table = F.create_map(*[c for t, _ in tables for c in (F.lit(t), F.array(*[
            F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).cast("bigint").alias("m")) for s, i, m in choices if s == t]))])
        level = (full.filter(F.col("n") > bucket)
                 .select("fp", F.explode(F.element_at(table, F.col("t"))).alias("x"))
                 .select("fp", F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("k")))
        tables = finer
    raise AssertionError("unreachable")


def _components(prints: DataFrame, radius: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """From (id, fp): (fp, group) of every fingerprint and (group, component) of every group.

    Fingerprints are the nodes; ``component`` is the least id of a group, null if none is known."""
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), radius, bucket))
    groups = staged(nodes.join(roots, nodes.fp == roots.node, "left")
                    .select("fp", "least", F.coalesce("component", "fp").alias("group")), "groups")
    return groups.select("fp", "group"), groups.groupBy("group").agg(F.min("least").alias("component"))


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                   radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(key, fp, component): component is the smallest id reachable over links of at most
    ``radius`` differing bits, itself included; one row per input row."""
    prints = staged(fingerprints(docs, key, text, shingle).withColumnRenamed(key, "id"), "fingerprints")
    groups, least = _components(prints, radius, bucket)
    return (prints.join(groups.join(least, "group").select("fp", "component"), "fp")
            .select(F.col("id").alias(key), "fp", "component"))


def one_row_a_group(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """One row of every group of ``simhash_groups``, all columns kept.

    It is the row with the least id, nulls last; among several the one whose text has the
    least XXH64, and of equal texts the first."""
    rows, row = identified(docs, "numbered-documents")
    order = F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("key"),
                     F.xxhash64(F.col(text).cast("string")).alias("text"), F.col(row).alias("row"))
    prints = staged(fingerprints(rows.select(order.alias("id"), F.col(text).alias("text")), "id", "text", shingle), "fingerprints")
    _, least = _components(prints, radius, bucket)
    kept = least.select(F.col("component.row").alias(row))
    return without(rows, row, prints.select(F.col("id.row").alias(row)).join(kept, row, "left_anti")).drop(row)

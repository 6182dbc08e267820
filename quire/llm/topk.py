"""Exact top-k inner products with impact-ordered, score-at-a-time index blocks.

Every vector is quantised to integers and dealt into index blocks.  In a block each
dimension is cut into impact levels, and a posting segment lists the vectors of one level of
one dimension.  A query processes the segments of a block by descending contribution above
the dimension's least one and adds the certain part to its accumulators.  What is not yet
processed, and the width of the levels, bound what any vector can still gain.  It stops only
when the bound proves that all but a few vectors cannot be among the best, and rescores the
possible members exactly from the stored vectors.  Every row is indexed; nothing is approximate.

Queries are dealt in batches and meet the blocks pairwise; a task holds one block and one
batch.  Best lists of blocks are merged by rank with a partial limit before the shuffle.

Vectors that are null or hold null or non-finite components, and rows without id, take no part.
Shorter vectors count as padded with zeros; empty ones score 0.  Components are 64-bit integers
after quantising; one that does not fit raises, and so does a best score that does not.  Where sums of a
block and a query could leave 64 bits, they are scored in unbounded integers.  Ties go to the smaller id, then to the earlier
row; rows that repeat an id are queries and candidates of their own.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import staged

LEVELS = 16
BLOCK_ROWS = 16_384
BATCH_QUERIES = 256
#: possible members, or a quarter of a block if more, at which a proof is good enough to rescore
FEW = 64


class Block:
    """Posting segments of one block of integer vectors (n x d)."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        n, d = vectors.shape
        self.vectors, self.levels = vectors, levels
        self.most = max(abs(int(vectors.min(initial=0))), abs(int(vectors.max(initial=0))))
        if 4 * self.most >= 1 << 62:                                # segments need sums of components
            return
        low = vectors.min(axis=0).astype(np.int64)
        high = vectors.max(axis=0).astype(np.int64)
        width = np.maximum(1, -(-(high - low + 1) // levels))
        level = (vectors - low) // width
        self.ids = np.argsort(level, axis=0, kind="stable").T.astype(np.intp, order="C")      # d x n
        counts = np.zeros((d, levels), np.int64)
        for j in range(d):
            counts[j] = np.bincount(level[:, j], minlength=levels)
        self.offset = np.concatenate((np.zeros((d, 1), np.int64), counts.cumsum(axis=1)), axis=1)
        self.floor = low[:, None] + width[:, None] * np.arange(levels)               # least value of a level
        self.ceil = np.minimum(self.floor + width[:, None] - 1, high[:, None])
        self.used = counts > 0

    def possible(self, query: np.ndarray, k: int, own: int = -1) -> np.ndarray:
        """Positions that may be among the best k, all but ``own``; all others are proven out."""
        n = len(self.vectors)
        candidates = n - (own >= 0)
        if candidates <= max(k, FEW):
            return np.array([i for i in range(n) if i != own], np.int64)
        q = query[:, None]
        least = np.where(q >= 0, q * self.floor, q * self.ceil)
        most = np.where(q >= 0, q * self.ceil, q * self.floor)
        base = np.where(self.used, least, np.iinfo(np.int64).max).min(axis=1)        # of each dimension
        gain = least - base[:, None]
        top = np.where(self.used, most - base[:, None], 0)
        dims, levels = np.nonzero(self.used & (gain > 0))
        order = np.argsort(-gain[dims, levels], kind="stable")
        dims, levels = dims[order], levels[order]
        # what a vector may still gain in a dimension: the largest level left, or a level's width
        slack = np.where(self.used, most - least, 0).max(axis=1)
        left = np.where(self.used, top, 0).max(axis=1)
        waiting = self._waiting(gain, top)
        score = np.zeros(n, np.int64)
        if own >= 0:
            score[own] = np.iinfo(np.int64).min // 4
        bound = int(left.sum())
        look = 0.7 * bound
        for j, level in zip(dims.tolist(), levels.tolist()):
            score[self.ids[j, self.offset[j, level]:self.offset[j, level + 1]]] += gain[j, level]
            bound -= int(left[j])
            left[j] = max(waiting[j].pop(), slack[j])
            bound += int(left[j])
            if bound < look:
                look = 0.7 * bound
                kth = np.partition(score, n - k)[n - k]
                if np.count_nonzero(score >= kth - bound) <= max(FEW, n // 4):
                    break
        kth = np.partition(score, n - k)[n - k]
        found = np.flatnonzero(score >= kth - bound)
        return found[found != own]

    def _waiting(self, gain: np.ndarray, top: np.ndarray) -> list[list[int]]:
        """Per dimension the largest possible gain of the levels after the first, second, ... processed;
        taken from the end."""
        out = []
        for j in range(len(gain)):
            at = np.flatnonzero(self.used[j])
            at = at[np.argsort(-gain[j, at], kind="stable")]
            out.append([0, *np.maximum.accumulate(top[j, at][::-1])[:-1].tolist()])
        return out

    def best(self, query: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, own: int = -1) -> list[tuple[int, int]]:
        """(position, score) of the best k, exact."""
        if 4 * self.most * sum(abs(x) for x in query.tolist()) >= 1 << 63:      # bounds and sums need not fit
            found = np.array([i for i in range(len(ids)) if i != own], np.int64)
            scores = self.vectors[found].astype(object) @ query.astype(object)
            order = sorted(range(len(found)), key=lambda i: (-scores[i], ids[found[i]], rows[found[i]]))[:k]
            return [(int(found[i]), scores[i]) for i in order]
        found = self.possible(query, k, own)
        scores = self.vectors[found].astype(np.int64) @ query
        order = np.lexsort((rows[found], ids[found], -scores))[:k]
        return list(zip(found[order].tolist(), scores[order].tolist()))


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as bigint; null if the vector takes no part."""
    numbers = vector.cast("array<double>")
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(numbers, lambda x: x * scale)
    small = F.forall(scaled, lambda x: F.abs(x) < float(2 ** 63))
    whole = F.when(small, F.transform(scaled, lambda x: F.floor(x).cast("bigint"))).otherwise(
        F.raise_error(F.lit("a component does not fit in 64 bits")).cast("array<bigint>"))
    return F.when(~bad, whole)


def top_k(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5,
          scale: int = 256, block_rows: int = BLOCK_ROWS, batch_queries: int = BATCH_QUERIES) -> DataFrame:
    """(query_id, rank, key, score): for every row where ``is_query`` holds, its best other rows.

    ``is_query`` is a condition on the columns of ``vectors``."""
    base = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("id"), is_query.alias("asks"),
        quantise(F.col(vector), scale).alias("v")
    ).filter("v is not null and id is not null")
    base = staged(base, "vectors")
    n, asking, dims, low, high = base.agg(
        F.count("*"), F.count_if("asks"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    kind = np.int32 if -2 ** 31 <= (low or 0) and (high or 0) < 2 ** 31 else np.int64       # of the stored blocks
    n_blocks, n_batches = max(1, -(-n // block_rows)), max(1, -(-asking // batch_queries))
    dims = dims or 0

    blocks = base.select("row", "id", "v", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int").alias("block"))

    def matrix(lists) -> np.ndarray:
        out = np.zeros((len(lists), max(dims, 1)), kind)
        for i, x in enumerate(lists):
            out[i, :len(x)] = x
        return out

    def gathered(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row")
        return pd.DataFrame({"block": part["block"].iloc[:1], "rows": [part["row"].to_numpy("<i8").tobytes()],
                             "ids": [part["id"].to_numpy("<i8").tobytes()], "m": [matrix(part["v"]).tobytes()]})

    index = staged(blocks.groupBy("block").applyInPandas(gathered, "block int, rows binary, ids binary, m binary"), "blocks")
    batches = (base.filter("asks").groupBy(F.pmod(F.xxhash64("row", F.lit("batch")), F.lit(n_batches)).cast("int").alias("batch"))
               .agg(F.collect_list(F.struct("row", "id", "v")).alias("queries")))
    pairs = (index.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_batches - 1))).alias("batch"))
             .join(batches.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")), ["block", "batch"]))

    def searched(arrived):
        for batch in arrived:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("rows", "ids", "m", "queries")}
                rows, ids = (np.frombuffer(row[c], "<i8") for c in ("rows", "ids"))
                block = Block(np.frombuffer(row["m"], kind).reshape(len(rows), -1))
                out = [[] for _ in range(5)]
                for q in row["queries"]:
                    at = int(np.searchsorted(rows, q["row"]))
                    own = at if at < len(rows) and rows[at] == q["row"] else -1
                    for place, score in block.best(matrix([q["v"]])[0].astype(np.int64), ids, rows, k, own):
                        for x, value in zip(out, (q["row"], q["id"], int(rows[place]), int(ids[place]), score)):
                            x.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["asked", "query_id", "row", "id", "score"])

    scored = pairs.select("rows", "ids", "m", "queries").mapInArrow(
        searched, "asked bigint, query_id bigint, row bigint, id bigint, score bigint")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "id", "row")
    return (scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(key), "score"))

"""Ranked lexical search: MaxScore over document blocks, its bounds tightened by term pairs.

``build_index`` cuts the corpus into blocks of consecutive documents and writes a block's whole
inverted file as one row.  ``pair_index`` prepares the blocks for a workload of queries: the
impacts of their terms, and for pairs of terms of one query the documents that hold both, with
their number and their largest joint impact.  Short intersection lists are stored, longer ones
leave their bound.  A search walks the blocks and keeps each query's best list:

- terms are taken by rising maximum impact, and a prefix of them is bounded by matching its terms
  into pairs: a pair counts with its joint maximum, the others with their own;
- the largest prefix whose bound is under the k-th best score so far is non-essential: a document
  that holds no other term cannot enter.  Where two or more of the next terms are needed to get
  there, their short intersection lists replace their own lists;
- documents of the essential lists are scored, the other terms are looked up for them from the
  largest down, and whoever cannot reach the k-th score any more is dropped.

Scores equal to the k-th are never skipped, so results are exact and ties go to the smaller id.
The k-th scores of a few blocks, searched first, are lower bounds that start all others.

Blocks are rows of a staged table, searched where they are read: no postings are shuffled and hot
terms are split by blocks.  Queries travel to the tasks in slices of bounded size, each a scan of the index.

Null, empty and wordless texts are no documents; a very long text is a block of its own.  Repeated rows are documents of their
own; rows without id are ranked last among equal scores.  Items without words get no rows; repeated items each get theirs.
Other columns are ignored, whatever their names.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import numbered, slices, staged

#: tokens and documents of a block
BLOCK_TOKENS, BLOCK_DOCS = 2_000_000, 32_768
#: a term of a query is paired with so many terms next to it in weight
PARTNERS = 32
#: blocks searched first for starting thresholds
PRIME_BLOCKS = 2
#: bytes of query terms that travel to the tasks together
SLICE_BYTES = 8 << 20
_TEXT_BYTES = 1 << 20

#: A-Z to lower case; digits, letters and all bytes of non-ASCII characters stay, the rest separates
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _pieces(text: bytes):
    """Terms of a text, a bounded piece at a time."""
    text, at = text.translate(_WORDS), 0
    while at < len(text):
        end = text.find(b" ", at + _TEXT_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


_BLOCK = ("block bigint, n_docs int, n_tokens bigint, ids array<bigint>, lengths binary, terms array<binary>, "
          "df array<int>, docs binary, tfs binary")
_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64())),
                          ("lengths", pa.binary()), ("terms", pa.list_(pa.binary())), ("df", pa.list_(pa.int32())),
                          ("docs", pa.binary()), ("tfs", pa.binary())])


def _blocks(batches):
    number = TaskContext.get().partitionId() << 33
    vocabulary, ids, lengths, words, tokens = {}, [], [], [], 0

    def block():
        nonlocal number, vocabulary, ids, lengths, words, tokens
        n = len(ids)
        held = np.concatenate(words).astype(np.int64) * n + np.repeat(np.arange(n), lengths)
        held, tf = np.unique(held, return_counts=True)
        term, doc = np.divmod(held, n)
        out = pa.RecordBatch.from_pylist([{
            "block": number, "n_docs": n, "n_tokens": tokens, "ids": ids, "lengths": np.array(lengths, "<i4").tobytes(),
            "terms": list(vocabulary), "df": np.bincount(term, minlength=len(vocabulary)), "docs": doc.astype("<i4").tobytes(),
            "tfs": tf.astype("<i4").tobytes()}], _BLOCK_ARROW)
        number, vocabulary, ids, lengths, words, tokens = number + 1, {}, [], [], [], 0
        return out

    for batch, texts in slices(batches, "text"):
        for key, text in zip(batch.column("id").to_pylist(), texts):
            length = 0
            for piece in _pieces(text or b""):
                words.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in piece), np.int32, len(piece)))
                length += len(piece)
            if length:
                ids.append(key)
                lengths.append(length)
                tokens += length
                if tokens >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                    yield block()
    if ids:
        yield block()


def build_index(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The blocks of all documents, staged: ids, lengths and the whole inverted file of each."""
    return staged(documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
                  .mapInArrow(_blocks, _BLOCK), "lexical-index")


def _query_terms(batches):
    for batch, texts in slices(batches, "text"):
        rows = [(q, item, w) for q, item, text in zip(batch.column("query").to_pylist(), batch.column("item").to_pylist(), texts)
                for w in dict.fromkeys(w for piece in _pieces(text or b"") for w in piece)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.binary())], ["query", "item", "term"])


def weighted_queries(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text"):
    """((query, item, terms, weights) staged, documents, tokens): the items' terms that the corpus
    holds and their weights.  Terms of weight zero add nothing and are left out."""
    n_docs, n_tokens = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    rows, number = numbered(items.select(F.col(key).cast("bigint").alias("item"), F.col(text).alias("text")), "items")
    asked = staged(rows.select(F.col(number).alias("query"), "item", "text").mapInArrow(
        _query_terms, "query bigint, item bigint, term binary"), "query-terms")
    held = (index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
            .join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    return staged(asked.join(held, "term").withColumn("w", weight).filter("w > 0").groupBy("query", "item").agg(
        F.array_sort(F.collect_list(F.struct("w", "term"))).alias("t")).select(
        "query", "item", F.col("t.term").alias("terms"), F.col("t.w").alias("weights")), "queries"), n_docs, n_tokens


class Workload:
    """Queries of one slice, as numbers of a shared vocabulary, and the pairs of their terms."""

    def __init__(self, rows, n_docs: int, n_tokens: int):
        self.n_docs, self.n_tokens = n_docs, n_tokens
        self.vocabulary: dict[bytes, int] = {}
        weights, self.queries, pairs = [], [], set()
        for row in rows:
            own = []
            for term, w in zip(row["terms"], row["weights"]):
                t = self.vocabulary.setdefault(bytes(term), len(self.vocabulary))
                if t == len(weights):
                    weights.append(w)
                own.append(t)
            self.queries.append((row["query"], row["item"], own))           # by rising weight
            for i, a in enumerate(own):
                pairs.update((min(a, b), max(a, b)) for b in own[i + 1:i + 1 + PARTNERS])
        self.weights = np.array(weights, np.int64)
        self.pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)

    def impacts(self, terms: np.ndarray, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The factor beside the weight, under a million."""
        m = 50 + (50 * lengths * self.n_docs) // self.n_tokens
        return (1_000_000_000 * tfs) // (1000 * tfs + 20 * m)


_PAIRS = ("block bigint, ids array<bigint>, terms binary, ends binary, docs binary, factors binary, "
          "first binary, second binary, joint binary, held binary, list_ends binary, list_docs binary")
_PAIRS_ARROW = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64()))] +
                         [(x.split()[0], pa.binary()) for x in _PAIRS.split(", ")[2:]])


def _prepared(work: Workload):
    """Blocks in, their pair index out."""
    def prepare(batches):
        for batch in batches:
            for row in batch.to_pylist():
                known = [(t, i) for i, t in enumerate(work.vocabulary.get(x, -1) for x in row["terms"]) if t >= 0]
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                docs, tfs = np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["tfs"], "<i4")
                ends = np.concatenate(([0], np.cumsum(row["df"], dtype=np.int64)))
                at = [np.arange(ends[i], ends[i + 1]) for _, i in known]
                sizes = np.array([len(x) for x in at], np.int64)
                at = np.concatenate(at) if at else np.empty(0, np.int64)
                terms = np.array([t for t, _ in known], np.int64)
                docs, owner = docs[at], np.repeat(terms, sizes)
                factors = work.impacts(owner, tfs[at].astype(np.int64), lengths[docs])
                held = _joint(work, terms, sizes, docs, factors * work.weights[owner], row["n_docs"])
                yield pa.RecordBatch.from_pylist([{
                    "block": row["block"], "ids": row["ids"], "terms": terms.astype("<i4").tobytes(),
                    "ends": np.cumsum(sizes).astype("<i8").tobytes(), "docs": docs.astype("<i4").tobytes(),
                    "factors": factors.astype("<i4").tobytes(), **held}], _PAIRS_ARROW)
    return prepare


def _joint(work: Workload, terms, sizes, docs, impacts, n_docs: int) -> dict:
    """Pairs whose two terms the block holds: number of common documents, largest joint impact,
    and the documents where they are few."""
    most = max(16, n_docs // 64)
    place = np.full(len(work.vocabulary), -1, np.int64)
    place[terms] = np.arange(len(terms))
    a, b = place[work.pairs[:, 0]], place[work.pairs[:, 1]]
    both = (a >= 0) & (b >= 0)
    a, b = a[both], b[both]
    swap = sizes[a] < sizes[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)              # the longer list first
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    joint, count = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    lists, dense = [], np.zeros(n_docs, np.int64)
    cuts = np.concatenate((np.flatnonzero(np.diff(a, prepend=-1)), [len(a)]))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = slice(starts[a[lo]], ends[a[lo]])
        dense[docs[own]] = impacts[own]
        at = np.concatenate([np.arange(starts[x], ends[x]) for x in b[lo:hi].tolist()])
        step = np.concatenate(([0], np.cumsum(sizes[b[lo:hi]])[:-1]))
        found = dense[docs[at]]
        common = found > 0
        joint[lo:hi] = np.maximum.reduceat(np.where(common, found + impacts[at], 0), step)
        count[lo:hi] = np.add.reduceat(common.astype(np.int64), step)
        kept = common & np.repeat(count[lo:hi] <= most, sizes[b[lo:hi]])
        lists.append(docs[at[kept]])
        dense[docs[own]] = 0
    listed = np.where(count <= most, count, 0)
    binary = lambda x, kind: np.asarray(x).astype(kind).tobytes()
    return {"first": binary(terms[a], "<i4"), "second": binary(terms[b], "<i4"), "joint": binary(joint, "<i8"), "held": binary(count, "<i4"),
            "list_ends": binary(np.cumsum(listed), "<i8"), "list_docs": binary(np.concatenate(lists) if lists else [], "<i4")}


class Block:
    """One block of the pair index, ready to search."""

    def __init__(self, row: dict, work: Workload):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids = np.array([0 if x is None else x for x in row["ids"]], np.int64)
        self.nameless = np.array([x is None for x in row["ids"]], bool)
        terms, ends = read("terms", "<i4"), read("ends", "<i8")
        docs, factors = read("docs", "<i4"), read("factors", "<i4").astype(np.int64)
        self.lists = {}
        at = 0
        for t, end in zip(terms.tolist(), ends.tolist()):
            impact = factors[at:end] * work.weights[t]
            self.lists[t] = (docs[at:end], impact, int(impact.max()))
            at = end
        joint, held, last = read("joint", "<i8").tolist(), read("held", "<i4").tolist(), read("list_ends", "<i8").tolist()
        self.common = read("list_docs", "<i4")
        size, most = len(work.vocabulary), max(16, len(self.ids) // 64)
        self.size = size
        self.pairs = {}
        for a, b, j, n, e in zip(read("first", "<i4").tolist(), read("second", "<i4").tolist(), joint, held, last):
            self.pairs[min(a, b) * size + max(a, b)] = (j, e - n, e) if n <= most else (j, -1, -1)

    def _pair(self, a: int, b: int):
        return self.pairs.get(min(a, b) * self.size + max(a, b))

    def prefix_bounds(self, terms: list[int]) -> list[int]:
        """Most that the first 0, 1, 2, ... terms can add up to in one document.  A term is matched
        with a free earlier one if their joint maximum is less than the sum of their own."""
        own = [self.lists[t][2] for t in terms]
        out, free = [0], []
        for j, t in enumerate(terms):
            best, partner = own[j], -1
            for i in free:
                pair = self._pair(terms[i], t)
                if pair is not None:
                    extra = max(pair[0], own[j], own[i]) - own[i]
                    if extra < best:
                        best, partner = extra, i
            if partner >= 0:
                free.remove(partner)
            else:
                free.append(j)
            out.append(out[-1] + best)
        return out

    def _clique(self, terms: list[int], bounds: list[int], edge: int, threshold: int):
        """(end, documents) replacing the lists of terms[edge:end] by intersections, or None.

        Documents that hold at most one term of terms[low:end] stay under the threshold, so those
        that matter are in one of the lists of its pairs."""
        best = None
        for low in range(edge, max(-1, edge - 8), -1):
            end = edge
            while end < len(terms) and bounds[low] + self.lists[terms[end]][2] < threshold:
                end += 1
            if end == edge or end - low < 2:
                continue
            pairs = [self._pair(terms[i], terms[j]) for j in range(max(edge, low + 1), end) for i in range(low, j)]
            if any(p is None or p[1] < 0 for p in pairs):
                continue
            cost = sum(p[2] - p[1] for p in pairs)
            saved = sum(len(self.lists[t][0]) for t in terms[edge:end]) - 2 * cost
            if saved > 0 and (best is None or saved > best[0]):
                best = (saved, end, pairs)
        if best is None:
            return None
        parts = [self.common[p[1]:p[2]] for p in best[2]]
        return best[1], np.unique(np.concatenate(parts))

    def search(self, query: list[int], threshold: int):
        """(positions, scores) of all documents that reach the threshold and some of them that don't; exact scores."""
        terms = sorted((t for t in query if t in self.lists), key=lambda t: self.lists[t][2])
        bounds = self.prefix_bounds(terms)
        edge = 0
        while edge < len(terms) and bounds[edge + 1] < threshold:
            edge += 1
        if edge == len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        end, extra = edge, None
        clique = self._clique(terms, bounds, edge, threshold)
        if clique is not None:
            end, extra = clique
        score = np.zeros(len(self.ids), np.int64)
        for t in terms[end:]:
            docs, impact, _ = self.lists[t]
            score[docs] += impact
        found = np.flatnonzero(score)
        if extra is not None:
            found = np.union1d(found, extra)
        score = score[found]
        for j in range(end - 1, -1, -1):
            keep = score + bounds[j + 1] >= threshold
            found, score = found[keep], score[keep]
            if not len(found):
                break
            docs, impact, _ = self.lists[terms[j]]
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            score = score + np.where(docs[at] == found, impact[at], 0)
        keep = score >= max(threshold, 1)
        return found[keep], score[keep]


class _Best:
    """The best k so far of one query."""

    def __init__(self, k: int, threshold: int):
        self.k, self.threshold = k, threshold
        self.score = self.ids = np.empty(0, np.int64)
        self.nameless = np.empty(0, bool)

    def add(self, block: Block, found, score) -> None:
        if not len(found):
            return
        score, ids, nameless = (np.concatenate(x) for x in ((self.score, score), (self.ids, block.ids[found]), (self.nameless, block.nameless[found])))
        order = np.lexsort((ids, nameless, -score))[:self.k]
        self.score, self.ids, self.nameless = score[order], ids[order], nameless[order]
        if len(order) == self.k:
            self.threshold = max(self.threshold, int(self.score[-1]))


def _searched(work: Workload, k: int, start: dict[int, int]):
    def search(batches):
        best = [_Best(k, start.get(q, 0)) for q, _, _ in work.queries]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, work)
                for held, (_, _, terms) in zip(best, work.queries):
                    held.add(block, *block.search(terms, held.threshold))
        for held, (query, item, _) in zip(best, work.queries):
            if len(held.score):
                n = len(held.score)
                yield pa.RecordBatch.from_arrays([
                    pa.array([query] * n, pa.int64()), pa.array([item] * n, pa.int64()), pa.array(held.ids, pa.int64(), mask=held.nameless),
                    pa.array(held.score, pa.int64())], ["query", "item", "doc", "score"])
    return search


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 50) -> DataFrame:
    """(item, rank, doc, score): the k best documents of the index for every row of ``items``."""
    queries, n_docs, n_tokens = weighted_queries(index, items, key, text)
    size = queries.agg(F.sum(F.aggregate("terms", F.lit(0), lambda n, t: n + F.length(t) + 16))).first()[0] or 0
    n_slices = -(-size // SLICE_BYTES)
    schema, out = "query bigint, item bigint, doc bigint, score bigint", None
    for part in range(n_slices):
        chosen = queries.filter(F.pmod(F.xxhash64("query"), F.lit(n_slices)) == part).orderBy("query").collect()
        if not chosen:
            continue
        work = Workload(chosen, n_docs, n_tokens)
        pairs = staged(index.mapInArrow(_prepared(work), _PAIRS), "pair-index")
        few = [r.block for r in pairs.select("block").orderBy(F.xxhash64("block")).limit(PRIME_BLOCKS).collect()]
        first = _ranked(pairs.filter(F.col("block").isin(few)).mapInArrow(_searched(work, k, {}), schema), k)
        start = {r.query: r.score for r in first.filter(F.col("rank") == k).collect()}
        found = pairs.mapInArrow(_searched(work, k, start), schema)
        out = found if out is None else out.union(found)
    if out is None:
        out = index.sparkSession.createDataFrame([], schema)
    return _ranked(out, k).select("item", "rank", "doc", "score")

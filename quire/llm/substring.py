"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words.  A word goes if a window that covers it also
starts in a document with a smaller id.  Steps:

1. Anchors.  Every window names its smallest ``phrase``-word phrase by hash, so equal windows
   name equal phrases.  Phrases found in different texts are the candidates; counting them
   is a combined aggregation of one number a phrase, about a fifth of a number a word.
2. Confirmation.  The runs of words around candidate phrases are compared by text: a window
   is a recurring passage if it starts in two documents, and its least document is noted.
3. Automata.  Passages are sharded by phrase.  A shard compiles an Aho-Corasick automaton
   (alphabet: words) of its passages, and all runs that hold the shard's phrases stream through
   it; every occurrence in a later document is reported.  Shards are cut so that an automaton
   has a bounded number of passages.
4. Removal.  The ranges join their documents, and covered words go.  Exact copies of a smaller
   document, known from two 64-bit hashes, skip steps 1 to 3 and lose all words of windows.

All documents are streamed in steps 1 and 4; only the parts that can hold a passage travel in
between.  A phrase with more than ``hot`` occurrences is not gathered anywhere: its different runs
and their windows are confirmed by combined aggregations and located by a join on two 64-bit hashes of the
run.  That join streams and spills, and adaptive execution splits the places of a very common run.

Words are runs of characters other than space and U+0009 to U+000D, unchanged.  Null texts have
none.  Texts shorter than a window stay whole.  Rows that repeat an id do not remove
each other's words; rows without id neither lose words nor remove any.  Long texts are hashed in
blocks.  An empty table gives no rows.  Only ``key`` and ``text`` are read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import slices, staged
from quire.llm.wordhash import mix, phrase_hashes, window_anchors, words_of

WINDOW = 13
PHRASE = 4
#: occurrences above which a phrase's windows are not gathered in one shard
HOT = 2048
#: runs of words a shard takes at a time; bounds the automaton
SHARD_RUNS = 8192


def anchors_of(word_hash: np.ndarray, first: np.ndarray, window: int, phrase: int):
    """(phrase hash per phrase, window starts, anchor phrase of each window) of several texts;
    ``first`` has their word bounds, windows across texts are left out."""
    p = phrase_hashes(word_hash, phrase)
    at = window_anchors(p, window - phrase + 1)
    if not len(at):
        return p, at, at
    stop = np.repeat(first[1:], np.diff(first))[:len(at)]          # word bound of each window's text
    starts = np.flatnonzero(np.arange(len(at)) + window <= stop)
    return p, starts, at[starts]


def _anchor_rows(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(a, id, c): anchor phrases of every document with their number of places."""
    def found(batches):
        for part, texts in slices(batches, "text", most_bytes=1 << 19):
            words = words_of(texts)
            p, _, at = anchors_of(words.hash, words.first, window, phrase)
            if not len(at):
                continue
            at = at[np.concatenate(([True], np.diff(at) != 0))]
            doc = np.searchsorted(words.first, at, "right") - 1
            value = p[at]
            order = np.lexsort((value, doc))
            value, doc = value[order], doc[order]
            new = np.flatnonzero(np.concatenate(([True], (np.diff(value) != 0) | (np.diff(doc) != 0))))
            counts = np.diff(np.append(new, len(value)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[new].view(np.int64)), part.column("id").take(pa.array(doc[new])), pa.array(counts, pa.int64())],
                ["a", "id", "c"])

    return docs.mapInArrow(found, "a bigint, id bigint, c bigint")


def _runs(held: DataFrame, window: int, phrase: int) -> DataFrame:
    """(a, hot, id, d1, start, run): the run of words around each place of the phrases in ``light`` and
    ``heavy`` (these are ``hot``), joined by one space."""
    def cut(batches):
        for part, texts in slices(batches, "text", most_rows=64):
            light, heavy = part.column("light"), part.column("heavy")
            out = [[] for _ in range(6)]
            for i, text in enumerate(texts):
                hashed = words_of([text])
                p, starts, at = anchors_of(hashed.hash, hashed.first, window, phrase)
                if not len(at):
                    continue
                edge = np.flatnonzero(np.concatenate(([True], np.diff(at) != 0, [True])))
                value = p[at[edge[:-1]]].view(np.int64)
                hot = np.isin(value, heavy[i].values.to_numpy())
                here = np.flatnonzero(hot | np.isin(value, light[i].values.to_numpy()))
                if not len(here):
                    continue
                words = text.split()
                lo, hi = starts[edge[here]].tolist(), (starts[edge[here + 1] - 1] + window).tolist()
                out[0] += value[here].tolist()
                out[1] += [part.column("id")[i].as_py()] * len(here)
                out[2] += [part.column("d1")[i].as_py()] * len(here)
                out[3] += lo
                out[4] += [b" ".join(words[s:e]) for s, e in zip(lo, hi)]
                out[5] += hot[here].tolist()
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x, pa.int64()) for x in out[:4]], pa.array(out[4], pa.binary()), pa.array(out[5], pa.bool_())],
                ["a", "id", "d1", "start", "run", "hot"])

    return held.mapInArrow(cut, "a bigint, id bigint, d1 bigint, start bigint, run binary, hot boolean")


def _windows(runs: DataFrame, window: int) -> DataFrame:
    """(run, place, passage, least, most): every window of distinct runs."""
    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                whose, place, passage = [], [], []
                for i, run in enumerate(part.column("run").to_pylist()):
                    words = run.split(b" ")
                    n = len(words) - window + 1
                    whose += [i] * n
                    place += range(n)
                    passage += [b" ".join(words[k:k + window]) for k in range(n)]
                took = pa.array(whose, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("run").take(took), pa.array(place, pa.int64()), pa.array(passage, pa.binary()),
                     part.column("least").take(took), part.column("most").take(took)], ["run", "place", "passage", "least", "most"])

    return runs.mapInArrow(cut, "run binary, place bigint, passage binary, least bigint, most bigint")


def _ranges(ends: list[int], window: int) -> list[tuple[int, int]]:
    """(first word, last word) of touching windows that end at ``ends``."""
    out = []
    for e in ends:
        if out and e - window < out[-1][1] + 1:
            out[-1] = (out[-1][0], e)
        else:
            out.append((e - window + 1, e))
    return out


def locate(ids: np.ndarray, runs: list[bytes], window: int) -> list[tuple[int, int, int]]:
    """(run, first word, last word) of passages that also start in a smaller document.

    Confirms the windows that start in two documents, compiles one automaton of them, and
    streams every different run through it."""
    index: dict[bytes, int] = {}
    which = np.fromiter((index.setdefault(r, len(index)) for r in runs), np.int64, len(runs))
    words = b" ".join(index).split(b" ") if index else []
    number = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
    flat = list(map(number.__getitem__, words))
    first = np.concatenate(([0], np.cumsum([r.count(b" ") + 1 for r in index], dtype=np.int64)))
    order = np.lexsort((ids, which))                       # the rows of a run by document
    rows = np.searchsorted(which[order], np.arange(len(index) + 1))
    least, most = ids[order[rows[:-1]]], ids[order[rows[1:] - 1]]
    starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(first[:-1], first[1:])]) if index else first[:0]
    if not len(starts):
        return []
    value = phrase_hashes(mix(np.array(flat, np.uint64)), window)[starts]
    run = np.searchsorted(first, starts, "right") - 1
    by = np.argsort(value, kind="stable")
    new = np.flatnonzero(np.concatenate(([True], np.diff(value[by]) != 0)))
    low, high = np.minimum.reduceat(least[run[by]], new), np.maximum.reduceat(most[run[by]], new)
    recurring = np.flatnonzero(low < high)
    if not len(recurring):
        return []
    passages = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    at = starts[by[new[recurring]]].tolist()
    for n, s in enumerate(at):
        passages.add_word(tuple(flat[s:s + window]), n)
    passages.make_automaton()
    low = low[recurring].tolist()
    found = []
    for u in np.unique(run[np.isin(value, value[by[new[recurring]]])]).tolist():
        hits = [(e, low[n]) for e, n in passages.iter(tuple(flat[first[u]:first[u + 1]]))]
        top = max((f for _, f in hits), default=0)
        everywhere = _ranges([e for e, _ in hits], window)
        for r in order[rows[u]:rows[u + 1]].tolist():
            here = everywhere if ids[r] > top else _ranges([e for e, f in hits if f < ids[r]], window)
            found += [(r, a, b) for a, b in here]
    return sorted(found)


def _located(runs: DataFrame, window: int, shard_runs: int) -> DataFrame:
    """Ranges found by the shards' automata (``run`` is null); the rows of a phrase arrive together.
    Runs of hot phrases pass through (``stop`` is null)."""
    names = ["id", "d1", "start", "stop", "run"]

    def streamed(batches):
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table):
            ids = table.column("id").to_numpy()
            start = table.column("start").to_numpy()
            found = locate(ids, table.column("run").to_pylist(), window)
            r = np.array([f[0] for f in found], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[r]), pa.array(table.column("d1").to_numpy()[r]),
                 pa.array(start[r] + np.array([f[1] for f in found], np.int64)),
                 pa.array(start[r] + np.array([f[2] for f in found], np.int64) + 1), pa.nulls(len(r), pa.binary())], names)

        def cut(last: bool):
            nonlocal held
            table = pa.Table.from_batches(held)
            phrase = table.column("a").to_numpy()
            at = 0
            while len(phrase) - at >= shard_runs:      # the next change of phrase
                change = np.flatnonzero(np.diff(phrase[at + shard_runs - 1:]))
                if not len(change):
                    break
                size = shard_runs + int(change[0])
                yield from done(table.slice(at, size))
                at += size
            if last:
                yield from done(table.slice(at))
            held = [] if last else table.slice(at).combine_chunks().to_batches()

        for batch in batches:
            hot = batch.filter(batch.column("hot"))
            if hot.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*[hot.column(c) for c in names[:3]], pa.nulls(hot.num_rows, pa.int64()), hot.column("run")], names)
            if hot.num_rows < batch.num_rows:
                held.append(batch.filter(pc.invert(batch.column("hot"))))
            if sum(b.num_rows for b in held) >= 2 * shard_runs:
                yield from cut(False)
        if held:
            yield from cut(True)

    return runs.mapInArrow(streamed, "id bigint, d1 bigint, start bigint, stop bigint, run binary")


def _removed(rows: DataFrame, window: int) -> DataFrame:
    """(id, n_words, n_removed, kept) from texts with the ranges and the copied texts of their id."""
    def cut(batches):
        for part, texts in slices(batches, "text"):
            out = [[] for _ in range(3)]
            ids, digests, copies, ranges = (part.column(c).to_pylist() for c in ("id", "d1", "copies", "ranges"))
            for i, text in enumerate(texts):
                words = text.split() if text else []
                n = len(words)
                own = [(a, a + r["size"]) for r in ranges[i] or () if r["d1"] == digests[i] for a in r["starts"]]
                if n >= window and digests[i] in (copies[i] or ()):
                    words = []
                elif own:
                    gone = np.zeros(n + 1, np.int64)
                    at = np.array(own)
                    np.add.at(gone, at[:, 0], 1)
                    np.add.at(gone, at[:, 1], -1)
                    words = [words[j] for j in np.flatnonzero(gone[:n].cumsum() == 0).tolist()]
                out[0].append(n)
                out[1].append(n - len(words))
                out[2].append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(cut, "id bigint, n_words bigint, n_removed bigint, kept string")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   phrase: int = PHRASE, hot: int = HOT, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """(key, n_words, n_removed, kept): ``kept`` holds the words that stay, joined by one space.  Steps 1 to 3
    run when it is called; what they found is written to the shared folder."""
    base = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    named = base.filter("id is not null").select("id", F.xxhash64("text").alias("d1"), "text")
    # exact copies of a smaller document, by id (an id that repeats may have several texts)
    digests = named.select("id", "d1", F.xxhash64(F.lit(1), "text").alias("d2"))
    least = digests.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    # the sides meet on the digests with a bit changed, so both come straight from an exchange and adaptive
    # execution splits a large group of copies
    meet = [F.col(d).bitwiseXOR(F.lit(1)).alias(f"{d}_") for d in ("d1", "d2")]
    copies = (digests.select("id", "d1", *meet).join(least.select("first", *meet), ["d1_", "d2_"]).filter("first < id")
              .groupBy("id").agg(F.collect_set("d1").alias("copies")))
    # every use of the texts reads this exchange; the other sides are small and hashed, so texts are not sorted
    texts = named.repartition("id")
    fresh = (texts.join(copies.hint("shuffle_hash"), "id", "left")
             .filter(~F.coalesce(F.array_contains("copies", F.col("d1")), F.lit(False))).select("id", "d1", "text"))

    anchors = _anchor_rows(fresh, window, phrase)
    recurring = (anchors.groupBy("a").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.sum("c").alias("n"))
                 .filter("x < y").select("a", (F.col("n") > hot).alias("hot")))
    mine = anchors.select("a", "id").join(recurring, "a").groupBy("id").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("a"))).alias("light"),
        F.collect_set(F.when(F.col("hot"), F.col("a"))).alias("heavy"))

    # the runs are cut once: those of a phrase meet at its automaton, those of hot phrases are spread by document
    # and pass through; what comes out is written, as it is read for the ranges and, three times, for the hot runs
    runs = _runs(fresh.join(mine.hint("shuffle_hash"), "id").select("id", "d1", "text", "light", "heavy"), window, phrase)
    dealt = runs.repartition(F.when(F.col("hot"), F.col("id")).otherwise(F.col("a"))).sortWithinPartitions("a")
    located = staged(_located(dealt, window, shard_runs), "located-runs")
    light = located.filter("run is null").select("id", "d1", "start", "stop")
    heavy = located.filter("run is not null").select("run", "id", "d1", "start")
    windows = _windows(heavy.groupBy("run").agg(F.min("id").alias("least"), F.max("id").alias("most")), window)
    passages = (windows.groupBy("passage").agg(F.min("least").alias("first"), F.max("most").alias("last"))
                .filter("first < last").select("passage", "first"))
    places = windows.select("run", "place", "passage").join(passages, "passage").groupBy("run").agg(
        F.collect_list(F.struct("place", "first")).alias("places"), F.min("first").alias("first"))
    # one row a run; its windows stay together in an array.  The sides meet on digests of the run, both straight
    # from an exchange, so that the places of a very common run are split over tasks; no run text travels
    digest = [F.xxhash64("run").alias("r1"), F.xxhash64(F.lit(1), "run").alias("r2")]
    found = heavy.select(*digest, "id", "d1", "start").join(
        places.select(*digest, "places", "first"), ["r1", "r2"]).filter("id > first").select("id", "d1", F.transform(
        F.filter("places", lambda p: p["first"] < F.col("id")), lambda p: F.col("start") + p["place"]).alias("starts"),
        F.lit(window).cast("bigint").alias("size"))
    light = light.select("id", "d1", F.array("start").alias("starts"), (F.col("stop") - F.col("start")).alias("size"))
    ranges = light.union(found).groupBy("id").agg(F.collect_list(F.struct("d1", "starts", "size")).alias("ranges"))
    known = ranges.join(copies, "id", "full")
    whole = texts.join(known.hint("shuffle_hash"), "id", "left").select("id", "d1", "text", "copies", "ranges")
    unnamed = base.filter("id is null").select(
        "id", F.lit(0).cast("bigint").alias("d1"), "text", F.lit(None).cast("array<bigint>").alias("copies"),
        F.lit(None).cast("array<struct<d1:bigint,starts:array<bigint>,size:bigint>>").alias("ranges"))
    return _removed(whole.union(unnamed), window).withColumnRenamed("id", key)

"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of its letter 1- to 3-grams (lower-cased, word ends
marked, hashed to ``dims`` buckets, counts damped by log).  Every language has several
centroids, found by spherical k-means; a text gets the language of the centroid with the
largest cosine.  It is rejected if that cosine lies under ``slack`` times the ``low`` quantile
of the cosines that training texts of the cluster reach at that length.  Length is the number of
distinct grams, in bands of half an octave (a repeated word is a short text); training texts
count whole and cut to their first 4, 8, 16... characters.  A cluster with under ``BAND_ROWS`` texts in
a band takes the band of its language, and that of a shorter band if those are too few as well.
A cluster of less than the share ``low`` of a language's sample gives no centroid, so a few odd
rows neither loosen a language nor become one of its centroids.

Document frequencies come from every training row.  Centroids are fitted on about ``sample``
texts a language, dealt by a hash of the id, and on at most ``max_labels`` languages (the
most frequent): both bounds are parameters.  What the driver holds is ``dims`` counts and
``max_labels * clusters`` centroids, whatever the number of documents.

Null texts and texts without a letter are ``und`` with score 0 and rejected.  With no
training rows every text is.  Very long texts are counted in pieces.  Repeated rows are
predicted one by one.  Equal cosines go to the language that sorts first.  Only the named
columns are read; language, source and id never reach a prediction.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
DIMS = 1 << 13
PIECE = 1 << 18
#: texts from which a length band has a quantile of its own
BAND_ROWS = 20


@functools.cache
def _letters() -> np.ndarray:
    """Is the code point a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str | None, dims: int = DIMS) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams; None if there is no letter."""
    if not text:
        return None
    total, tail, any_letter = None, np.zeros(1, np.uint32), False
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "replace"), np.uint32)
        is_letter = _letters()[codes]
        any_letter |= bool(is_letter.any())
        codes = np.concatenate((tail, np.where(is_letter, codes, np.uint32(0))))
        if at + PIECE >= len(text):
            codes = np.append(codes, np.uint32(0))
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)     # one mark between words
        keep[:len(tail)] = True
        codes = codes[keep]
        one, shift = codes[len(tail):], np.uint32(32 - (dims - 1).bit_length())
        grams = [one[one != 0] * np.uint32(2654435761)]
        if len(codes) > 1:
            two = codes[:-1] * np.uint32(2246822519) + codes[1:] * np.uint32(3266489917)
            new = two[len(tail) - 1:]                        # pairs inside the tail are counted
            grams.append((new ^ (new >> np.uint32(15))) * np.uint32(668265263))
            if len(codes) > 2:
                three = two[:-1] * np.uint32(374761393) + codes[2:] * np.uint32(2654435769)
                grams.append((three ^ (three >> np.uint32(13))) * np.uint32(2246822519))
        found = np.bincount(np.concatenate(grams) >> shift, minlength=dims)
        total = found if total is None else total + found
        tail = codes[-2:]
    return total if any_letter else None


def unit_vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x dims unit vectors, which texts have a letter)."""
    out = np.zeros((len(texts), len(idf)), np.float32)
    valid = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        counts = gram_counts(text, len(idf))
        if counts is not None:
            at = np.flatnonzero(counts)
            weight = np.log1p(counts[at]) * idf[at]
            norm = np.sqrt(weight @ weight)
            if norm > 0:
                out[i, at] = weight / norm
            valid[i] = True
    return out, valid


def _slices(batches, column: str, most_rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, most_rows):
            part = batch.slice(at, most_rows)
            yield part, part.column(column).to_pylist()


def document_frequency(train: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """Over all rows of ``train(text)``: rows with each bucket, and rows with a letter."""
    def counted(batches):
        seen = np.zeros(dims + 1, np.int64)
        for _, texts in _slices(batches, "text"):
            for text in texts:
                counts = gram_counts(text, dims)
                if counts is not None:
                    seen[:dims] += counts > 0
                    seen[dims] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at])], ["dim", "n"])

    frequency = np.zeros(dims + 1, np.int64)
    for row in train.select("text").mapInArrow(counted, "dim int, n bigint").groupBy("dim").agg(F.sum("n")).collect():
        frequency[row[0]] = row[1]
    return frequency[:dims], int(frequency[dims])


def k_means(vectors: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds; (unit centroids, member of each row)."""
    chosen = [vectors.sum(axis=0)]
    near = vectors @ (chosen[0] / max(np.linalg.norm(chosen[0]), 1e-9))
    while len(chosen) < min(k, len(vectors)):
        chosen.append(vectors[int(np.argmin(near))])
        near = np.maximum(near, vectors @ chosen[-1])
    centroids = np.array([c / max(np.linalg.norm(c), 1e-9) for c in chosen], np.float32)
    for _ in range(rounds):
        member = np.argmax(vectors @ centroids.T, axis=1)
        for c in range(len(centroids)):
            mean = vectors[member == c].sum(axis=0)
            if (norm := np.linalg.norm(mean)) > 0:
                centroids[c] = mean / norm
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def bands(grams: np.ndarray, dims: int) -> np.ndarray:
    """The length band of each number of distinct grams: half octaves, up to ``dims``."""
    return np.floor(2 * np.log2(np.clip(grams, 1, dims))).astype(int)


def reach(texts: list[str | None], idf: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(band, cluster, cosine) of the texts, whole and cut to their first 4, 8, 16... characters."""
    found, longest = [], max((len(t) for t in texts if t), default=0)
    sizes = [1 << i for i in range(2, longest.bit_length()) if 1 << i < min(longest, PIECE)]
    for size in [*sizes, None]:
        vectors, valid = unit_vectors([t[:size] for t in texts if t and (size is None or len(t) > size)], idf)
        cosine = vectors[valid] @ centroids.T
        found.append((bands((vectors[valid] > 0).sum(axis=1), len(idf)), cosine.argmax(axis=1), cosine.max(axis=1)))
    return tuple(np.concatenate(x) for x in zip(*found))


def low_reach(band: np.ndarray, cluster: np.ndarray, cosine: np.ndarray, clusters: int, n_bands: int, low: float) -> np.ndarray:
    """(clusters x bands): the ``low`` quantile of the cosines of each cluster and length band."""
    out = np.zeros((clusters, n_bands))
    full = [b for b in range(n_bands) if (band == b).sum() >= BAND_ROWS]
    first = full[0] if full else n_bands
    short = np.quantile(cosine[band < first], low) if (band < first).any() else 1.0
    if full:                                  # too few texts are as short: no stricter than the first full band
        short = min(short, np.quantile(cosine[band == first], low))
    for c in range(clusters):
        last = short
        for b in range(n_bands):
            if b in full:
                own = (band == b) & (cluster == c)
                last = np.quantile(cosine[own if own.sum() >= BAND_ROWS else band == b], low)
            out[c, b] = last
    return out


def fit(train: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text", dims: int = DIMS,
        clusters: int = 3, sample: int = 600, max_labels: int = 1000, slack: float = 0.5,
        low: float = 0.02) -> dict:
    """A model (plain dict of numpy arrays) from labelled rows; null labels are ignored."""
    rows = train.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(text).cast("string").alias("text")
                        ).filter("label is not null")
    frequency, n = document_frequency(rows, dims)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    labels = {r[0]: r[1] for r in rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max_labels).collect()}
    n_bands = int(bands(np.array([dims]), dims)[0]) + 1
    empty = {"idf": idf, "labels": [], "owner": np.zeros(0, int), "centroids": np.zeros((0, dims), np.float32),
             "radius": np.zeros((0, n_bands))}
    if not labels:
        return empty
    # about `sample` rows of each label: a label's share of a hash's range
    wide = 1 << 20
    share = F.create_map(*[x for name, count in labels.items() for x in (F.lit(name), F.lit(min(wide, -(-sample * wide // count))))])
    drawn = rows.filter(F.pmod(F.xxhash64("key", F.lit("langid")), F.lit(wide)) < F.element_at(share, F.col("label")))

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "text"]).head(2 * sample)
        vectors, valid = unit_vectors(part["text"].tolist(), idf)
        vectors = vectors[valid]
        out = {"label": [], "centroid": [], "radius": []}
        if len(vectors):
            centroids, member = k_means(vectors, clusters)
            held = np.bincount(member, minlength=len(centroids))
            centroids = centroids[(held > 0) & (held >= low * len(vectors))]
            radius = slack * low_reach(*reach(part["text"].tolist(), idf, centroids), len(centroids), n_bands, low)
            for centroid, least in zip(centroids, radius):
                out["label"].append(part["label"].iloc[0])
                out["centroid"].append(centroid.astype("<f4").tobytes())
                out["radius"].append(least.tolist())
        return pd.DataFrame(out)

    kind = rows.schema["label"].dataType.simpleString()
    found = drawn.groupBy("label").applyInPandas(cluster, f"label {kind}, centroid binary, radius array<double>").collect()
    if not found:
        return empty
    found.sort(key=lambda r: str(r["label"]))
    names = sorted({r["label"] for r in found}, key=str)
    return {"idf": idf, "labels": names, "owner": np.array([names.index(r["label"]) for r in found]),
            "centroids": np.array([np.frombuffer(r["centroid"], "<f4") for r in found]),
            "radius": np.array([r["radius"] for r in found])}


def predict_texts(model: dict, texts: list[str | None]) -> tuple[list, np.ndarray, np.ndarray]:
    """(language, score, rejected) of each text."""
    vectors, valid = unit_vectors(texts, model["idf"])
    if not len(model["owner"]):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    cosine = vectors @ model["centroids"].T
    best = cosine.argmax(axis=1)              # centroids are in label order: ties go to the first
    score = np.clip(cosine[np.arange(len(texts)), best].astype(float), 0, 1)
    score[~valid] = 0
    band = bands((vectors > 0).sum(axis=1), vectors.shape[1])
    rejected = ~valid | (score < model["radius"][best, band])
    names = [str(model["labels"][model["owner"][b]]) if ok else UNDETERMINED for b, ok in zip(best, valid)]
    return names, score, rejected


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected; other columns pass through.

    Input columns of those three names are replaced."""
    fresh = ("lang_pred", "score", "rejected")
    rows = docs.drop(*fresh)
    names = rows.columns

    def predicted(batches):
        for part, texts in _slices(batches, text):
            lang, score, rejected = predict_texts(model, texts)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], [*names, *fresh])

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(predicted, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(key: Column) -> Column:
    """The fixed split: crc32 of the id as text, modulo 3, is 1.  A null id is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))

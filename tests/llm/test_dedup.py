import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from quire.llm import simhash, substring
from quire.llm.components import components
from quire.llm.wordhash import phrase_hashes, window_anchors, words_of


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, radius):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations([r for r in rows if r[0] is not None], 2):
        if (a ^ b).bit_count() <= radius:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows if i is not None}


@pytest.mark.parametrize("bucket", [2, 2048])
def test_simhash_equals_brute_force(messy, bucket):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in messy.collect()]
    want = brute_groups(rows, 3)
    got = simhash.simhash_groups(messy, bucket=bucket).collect()
    assert sorted((r.doc_id or 0, r.fp % 2 ** 64) for r in got) == sorted((i or 0, f) for i, f in rows)
    assert all(r.component == want[r.doc_id] for r in got if r.doc_id is not None)
    zero = min(i for i, f in rows if f == 0 and i is not None)
    assert all(r.component == zero for r in got if r.fp == 0)


def test_rows_without_id_link_and_repeated_ids_stay_apart(spark):
    import corpus_pipeline

    rng = random.Random(3)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    near = [" ".join(base[:i] + [f"x{i}"] + base[i + 1:]) for i in range(300)]
    prints = [brute_fingerprint(t) for t in near]
    far = lambda i, j: (prints[i] ^ prints[j]).bit_count()
    a, c, b = next((i, k, j) for i, j in combinations(range(300), 2) if far(i, j) > 3
                   for k in range(300) if far(i, k) <= 3 and far(k, j) <= 3)
    others = [" ".join(f"{x}{rng.randint(0, 10**6)}" for _ in range(50)) for x in "pqr"]
    docs = spark.createDataFrame([(7, near[a]), (None, near[c]), (3, near[b]), (5, others[0]), (5, others[1]),
                                  (None, others[2]), (None, others[2]), (None, others[1])], "doc_id long, text string")
    got = {(r.doc_id, r.fp % 2 ** 64): r.component for r in simhash.simhash_groups(docs).collect()}
    assert got[7, prints[a]] == got[None, prints[c]] == got[3, prints[b]] == 3
    assert got[None, brute_fingerprint(others[1])] == 5 and got[None, brute_fingerprint(others[2])] is None
    kept = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=repr)
    assert kept == sorted([(3, near[b]), (5, others[0]), (5, others[1]), (None, others[2])], key=repr)


def test_simhash_empty_table(no_rows):
    assert simhash.simhash_groups(no_rows).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_masks_cover_every_small_difference(radius):
    masks = simhash.covering_masks(radius, 16)
    for bits in combinations(range(16), radius):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_links_of_a_dense_cluster_are_complete_at_every_bucket_size(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(300):
        x = rng.choice(sorted(prints))
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [x - 2 ** 64 if x >> 63 else x for x in sorted(prints)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = brute_groups([(x, x % 2 ** 64) for x in signed], 3)
    for bucket in (3, 4096):
        edges = simhash.links(df, 3, bucket)
        assert edges.count() < 30 * len(prints)
        roots = {r.node: r.component for r in components(edges).collect()}
        assert {x: roots.get(x, x) for x in signed} == want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (500, 400), (500, 400)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 40)}, 500: 400}


def brute_kept(rows, window=13):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                s = tuple(w[k:k + window])
                first[s] = min(first.get(s, i), i)
    out = []
    for i, w in split:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = True
        out.append((i, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot,shard", [(0, 64), (3, 4), (2048, 8192)])
def test_substring_equals_brute_force(messy, hot, shard):
    want = brute_kept([(r.doc_id, r.text) for r in messy.collect()])
    got = substring.remove_repeats(messy, hot=hot, shard_runs=shard).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert sum(r.n_removed for r in got) > 300


def test_substring_empty_table(no_rows):
    assert substring.remove_repeats(no_rows).count() == 0


def test_word_hashes_do_not_depend_on_place_or_block(monkeypatch):
    text = b"alpha beta  gamma\tdelta\nalpha"
    one = words_of([text, b"", b"gamma beta"])
    h = one.hash
    assert h[0] == h[4] and h[1] == h[6] and h[2] == h[5] and len(set(h.tolist())) == 4
    assert one.first.tolist() == [0, 5, 5, 7]
    monkeypatch.setattr(type(one), "BLOCK", 4)
    monkeypatch.setattr(type(one), "_fwd", one._fwd[:5])
    monkeypatch.setattr(type(one), "_inv", one._inv[:5])
    assert words_of([text, b"", b"gamma beta"]).hash.tolist() == h.tolist()


def test_anchor_follows_the_window_only():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2 ** 63, 40).astype(np.uint64)
    p = phrase_hashes(h, 5)
    at = window_anchors(p, 9)
    for i in range(len(at)):
        alone = phrase_hashes(h[i:i + 13], 5)
        assert window_anchors(alone, 9)[0] + i == at[i] and alone.argmin() + i == at[i]


def test_locate_finds_only_later_documents():
    passage = b" ".join(b"w%d" % i for i in range(20))
    found = substring.locate(np.array([5, 2, 9]), [passage, b"x y " + passage, passage[4:]], 13)
    assert found == [(0, 0, 19), (2, 1, 18)]
    assert substring.locate(np.array([5, 5]), [passage, passage], 13) == []

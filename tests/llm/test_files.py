import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter
from math import log

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from quire.llm import chat, mixing, tokencount, topk, warc

PAGES = [(3, "http://a/", "<p>same</p>"), (1, "http://b/ x\r\ny", "<p>same</p>"), (2, None, None), (4, "http://c", ""),
         (None, "http://d", "<p>same</p>"), (5, "http://e", "é" * 70_000), (6, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
         (7, "u", "<p>once</p>"), (8, "u", "x"), (8, "u", "x")]
PAGE_SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, PAGE_SCHEMA).withColumn("file", F.lit("clash")).withColumn("seq", F.lit(9)).withColumn("id", F.lit(1))


def expected(rows, min_bytes):
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    for n in order:
        key, _, html = rows[n]
        data = (html or "").encode()
        sha1 = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = len(data) >= min_bytes and sha1 in first
        out.append((key, len(data), sha1, "revisit" if again else "response", first[sha1] if again else None))
        first.setdefault(sha1, key)
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes,file_bytes,task", [(0, 64 << 20, 2048), (0, 1, 1), (5, 4000, 2)])
def test_archives_read_back(pages, min_bytes, file_bytes, task):
    got = warc.archive_pages(pages, min_bytes=min_bytes, file_bytes=file_bytes, records_a_task=task)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == expected(PAGES, min_bytes)


def test_every_record_is_a_member_and_payloads_survive(pages):
    manifest = warc.write_monolithic(pages, file_bytes=10 ** 9)
    for r in manifest.select("file").distinct().collect():
        store, path = warc._store(r.file)
        data = store.open_input_stream(path, compression=None).read()
        d = zlib.decompressobj(31)
        d.decompress(data)
        assert d.eof and not d.unused_data                      # one gzip stream a file
    archives = warc.normalise(manifest)
    for r in archives.collect():
        store, path = warc._store(r.archive)
        data = store.open_input_stream(path, compression=None).read()
        store, path = warc._store(r.sidecar)
        lines = store.open_input_stream(path).read().decode().splitlines()
        assert len(lines) == r.n
        for line in lines:
            a, n = int(line[:20]), int(line[21:41])
            assert gzip.decompress(data[a:a + n]).startswith(b"WARC/1.1\r\n")
        assert sum(int(x[21:41]) for x in lines) == len(data)
    back = {r.page_id: r.payload for r in warc.read_records(archives, with_payload=True).collect()}
    assert back[5].decode() == "é" * 70_000 and back[6].startswith(b"WARC/1.1") and back[2] == b""


def test_truncated_archive_raises(spark, tmp_path):
    record = b"".join(warc.response_record(1, "u", b"x" * 1000, "A", warc.DATE))
    for data in (gzip.compress(record)[:-20], gzip.compress(record[:-10])):
        (tmp_path / "cut.warc.gz").write_bytes(data)
        files = spark.createDataFrame([(f"file://{tmp_path}/cut.warc.gz",)], "file string")
        with pytest.raises(Exception, match="ends early|cut off|not closed"):
            warc.normalise(files)


def test_multi_member_and_empty_archives(spark, tmp_path):
    record = b"".join(warc.response_record(1, "u", b"abc", warc.digest(b"abc"), warc.DATE))
    (tmp_path / "many.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    (tmp_path / "none.warc.gz").write_bytes(gzip.compress(b""))
    files = spark.createDataFrame([(f"file://{tmp_path}/{n}.warc.gz",) for n in ("many", "none")], "file string")
    archives = warc.normalise(files)
    assert sorted(r.n for r in archives.collect()) == [0, 2] and warc.read_records(archives).count() == 2


def test_archives_of_an_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], PAGE_SCHEMA)).count() == 0


@pytest.mark.parametrize("block", [3, 64, 1 << 21])
def test_token_counts_equal_encoding(messy, block):
    rows = messy.select("doc_id", "text").filter("doc_id is null or doc_id < 110")
    if block == 3:
        rows = rows.filter("length(text) < 500 or text is null")
    got = sorted(((r.doc_id, r.n_tokens, r.terminated) for r in tokencount.token_counts(rows, block_tokens=block).collect()), key=repr)
    plain = tokencount._encoding(tokencount.RANKS)
    want = sorted(((r.doc_id, len(plain.encode_ordinary(r.text or "")), True) for r in rows.collect()), key=repr)
    assert got == want


def test_separator_scan_of_plain_files(spark, tmp_path):
    eod = 9
    for name, ids in {"a": [1, 2, 9, 9, 3, 9, 4, 5], "b": [9], "c": [], "d": [1, 1, 1]}.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u4").tobytes())
    files = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in "abcda"], "file string")
    for block in (1, 2, 100):
        got = sorted((r.file[-1], r.doc, r.start, r.n_tokens, r.terminated)
                     for r in tokencount.scan_separators(files, eod, "<u4", block).collect())
        assert got == [("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 1, True), ("a", 3, 6, 2, False),
                       ("b", 0, 0, 0, True), ("d", 0, 0, 3, False)]


def test_pieces_do_not_change_tokens(monkeypatch):
    text = "Alpha  beta, gamma delta\n\n epsilon's 123 zeta " * 30
    whole = tokencount.encode(text, tokencount.RANKS)
    monkeypatch.setattr(tokencount, "PIECE", 17)
    assert len(tokencount.pieces(text)) > 10 and (tokencount.encode(text, tokencount.RANKS) == whole).all()


def test_token_counts_of_an_empty_table(no_rows):
    assert tokencount.token_counts(no_rows).count() == 0


def brute_top(rows, k):
    held = []
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            held.append((key, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for n, (key, q) in enumerate(held):
        if key % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), other) for m, (other, v) in enumerate(held) if m != n)
            out += [(key, r + 1, other, -s) for r, (s, other) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(12)] + [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 8), (2150, [float("inf")]),
             (2200, []), (2250, [0.5, -0.5]), (None, [1.0] * 8), (150, rows[150][1]), (2300, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("x")).withColumn("block", F.lit(1)).withColumn("v", F.lit(2))
    for size, batch in ((10 ** 6, 256), (300, 4)):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=size, batch_queries=batch).collect()
        assert sorted(tuple(r) for r in got) == brute_top(rows, 5)


def test_top_k_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_block_stops_only_on_proof():
    rng = np.random.default_rng(7)
    vectors = np.concatenate([rng.integers(-80, 80, (3000, 16)), np.zeros((5, 16), int), np.full((3, 16), 7)]).astype(np.int32)
    block = topk.Block(vectors)
    for q in [*vectors[:20].astype(np.int64), np.zeros(16, np.int64), -vectors[3].astype(np.int64)]:
        scores = vectors.astype(np.int64) @ q
        possible = block.possible(q, 5)
        kth = np.sort(scores)[-5]
        assert set(np.flatnonzero(scores >= kth)) <= set(possible.tolist())
    assert len(block.possible(vectors[0].astype(np.int64) * 3, 5)) < 3000


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|><|im_start|>assistant ok <\\|im_sep|> <\\\\|"), (1, 2, "assistant", "\n\n lead and trail \n"),
         (2, None, None, None), (2, 1, "assistant", None), (3, 0, "assistant", "日本 é́ 🎉 <|endoftext|>"), (3, 1, "assistant", "<"), (3, 2, "assistant", "|x<"),
         (4, 0, "assistant", "again"), (4, 0, "assistant", "again"), (4, 0, "<|im_sep|>", "z"), (None, 0, "user", "lost"), (5, 0, "assistant", "a b " * 50_000)]


def test_chat_reads_back(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(1)).withColumn("turns", F.lit(2))
    made = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    by = {}
    for c, t, r, x in CHATS:
        by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    for c, turns in by.items():
        turns = [(r, x) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        sha = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars) == (len(turns), sha, len(loss))
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for r in made.collect():
        assert len(r.input_ids) == len(r.starts) == len(r.ends) == len(r.loss_mask)
        assert chat._tokenizer(chat.TOKENIZER).decode(r.input_ids, skip_special_tokens=False) == r.formatted
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_escape_is_reversible_and_hides_control_strings():
    rng = np.random.default_rng(8)
    for _ in range(5000):
        t = "".join(rng.choice(list("<|\\>a"), rng.integers(0, 12)))
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)


def test_masks_meet_tokens_by_binary_search():
    starts, ends = np.array([0, 2, 2, 5, 9]), np.array([2, 5, 5, 9, 12])
    assert chat.mask_tokens(starts, ends, [(2, 5), (9, 9)]).tolist() == [False, True, True, False, False]
    assert chat.mask_tokens(starts, ends, [(4, 10)]).tolist() == [False, True, True, True, True]


def mixed(df, **options):
    return mixing.mix(df, **options).collect()


def test_mixing_keeps_every_document_and_meets_its_weights(spark):
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(600)] + [(1000 + i, "w " * 5, f"s{i % 3}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("block", F.lit("old"))
    got = mixed(df, max_repetition=2.0, block_tokens=500, bin_rows=16)
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    total = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("big", "s0", "s1", "s2")}
    seen = {s: sum(r.n_tokens for r in got if r.source == s) for s in total}
    assert abs(seen["big"] - total["big"]) <= 8 and all(1.9 <= seen[s] / total[s] <= 2.05 for s in ("s0", "s1", "s2"))
    blocks = {}
    for r in got:
        blocks.setdefault(r.block, []).append(r)
    for b, held in blocks.items():
        if b < max(blocks):
            assert abs(sum(r.n_tokens for r in held) - 500) < 4 * 8
            assert {r.source for r in held} == set(total)
        assert all(0 <= r.position < 1 for r in held)
    order = [(r.doc_id, r.epoch) for r in got]
    assert len(order) == len(set(order))
    again = mixed(df, max_repetition=2.0, block_tokens=500, bin_rows=16)
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mixing_places_equal_a_prefix_sum(spark):
    rows = [(i, "w " * (i % 5), "a" if i % 3 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixed(df, max_repetition=3.0, block_tokens=64, bin_rows=8)
    for s in "ab":
        stream = sorted((r.block + r.position, r.n_tokens) for r in got if r.source == s)
        quota = None
        at = 0
        for place, n in stream:
            if at and quota is None:
                quota = at / place
            if quota:
                assert abs(place * quota - at) < 1e-6 * max(1, at)
            at += n


def test_mixing_bisects_to_the_target_entropy(spark):
    tokens = spark.createDataFrame([("a", 9000), ("b", 900), ("c", 100), (None, 0)], "source string, n_tokens long")
    target = 0.9 * log(3)
    weights, alpha, _ = mixing.source_weights(tokens, target_entropy=target, max_repetition=None)
    w = [r.weight for r in weights.collect() if r.weight]
    assert 0 < alpha < 1 and abs(sum(w) - 1) < 1e-9 and abs(-sum(x * log(x) for x in w) - target) < 1e-4
    assert mixing.source_weights(tokens, target_entropy=2.0, max_repetition=None)[1] == 0.0
    _, alpha, budget = mixing.source_weights(tokens, max_repetition=4.0, budget=10_000)
    w = {r.source: r.weight for r in mixing.source_weights(tokens, max_repetition=4.0, budget=10_000)[0].collect()}
    assert budget == 10_000 and abs(max(w[s] * budget / t for s, t in (("a", 9000), ("b", 900), ("c", 100))) - 4) < 1e-3


def test_mixing_messy_and_empty_tables(messy, no_rows):
    got = mixed(messy)
    keys = lambda rows: sorted({(r.doc_id, r.text and r.text[:50]) for r in rows}, key=repr)
    assert keys(got) == keys(messy.collect())
    assert mixed(no_rows) == []
    assert len(mixed(messy.filter("text is null"))) == messy.filter("text is null").count()


def test_mixing_spreads_rows_without_id_and_equal_rows(spark):
    """Half of the rows without id and a third equal in all: bins stay bounded, the input's order does not matter."""
    rows = [(None, f"text {i}", "a") for i in range(1500)] + [(None, "equal rows", "a")] * 1000 + [(7, "one id", "b")] * 300
    rows += [(i, "w " * (i % 9), "b") for i in range(200)]
    shuffled = random.Random(3).sample(rows, len(rows))
    seen = []
    for data, parts in ((rows, 4), (shuffled, 7)):
        df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(parts)
        got = mixed(df, max_repetition=1.0, block_tokens=512, bin_rows=64)
        assert len(got) >= len(rows)
        seen.append(sorted(map(repr, got)))
        places = [(r.block, r.position) for r in got if r.source == "a" and r.n_tokens]
        assert len(set(places)) == len(places)                   # every row of a source a place of its own
        spread = Counter(r.block for r in got if r.text == "equal rows")
        assert max(spread.values()) < 1000 / 3
    assert seen[0] == seen[1]


def test_mixing_leaves_other_columns_alone(spark):
    names = ("total_", "offset_", "order_", "key_", "bin_", "quota_", "epochs_", "row", "order", "bin", "total", "nth", "h1", "in", "row_number_")
    df = spark.createDataFrame([(i, f"t {i}", "s") for i in range(50)], "doc_id long, text string, source string")
    df = df.select("*", *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names], F.create_map(F.lit("k"), F.col("doc_id")).alias("map"))
    got = mixing.mix(df, max_repetition=1.0, bin_rows=8)
    assert got.columns == [*df.columns, "block", "position", "epoch", "n_tokens"]
    got = got.collect()
    assert len(got) == 50 and all(r[n] == f"{n} {r.doc_id}" for r in got for n in names)


def test_rows_of_files_are_told_apart_without_a_copy(spark, tmp_path):
    from quire.llm.common import identified
    df = spark.createDataFrame([(None, "same")] * 3000 + [(i, "x") for i in range(500)], "doc_id long, text string")
    df.repartition(7).write.parquet(f"{tmp_path}/d")
    read = spark.read.parquet(f"{tmp_path}/d").filter("text is not null").select("text", "doc_id")
    rows, row = identified(read, "t")
    assert rows.select(row).distinct().count() == 3500 and "file" in rows.schema[row].dataType.names
    again = {tuple(r[0]) for r in rows.select(row).filter("text = 'x'").collect()}
    assert again == {tuple(r[row]) for r in rows.collect() if r.text == "x"}
    for other in (read.union(read), read.join(read.select("text").distinct(), "text"), read.selectExpr("explode(array(1, 2)) AS n"),
                  read.filter("rand() < 0.5"), read.withColumn("_metadata", F.lit(1)), df):
        numbers, name = identified(other, "t")
        assert numbers.schema[name].dataType.typeName() == "long"
    got = mixing.mix(read.withColumn("source", F.lit("s")), max_repetition=1.0, bin_rows=64).collect()
    assert len(got) == 3500 and len({(r.block, r.position) for r in got}) == 3500


def test_topk_components_beyond_32_bits(spark):
    rows = [(0, [1.0, 0.5])] + [(i, [i * 1e8, -1.0]) for i in (1, 2, 3)] + [(4, [-(2.0 ** 45), 1.0]), (50, [2.0 ** 30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(256 * x // 1) for x in v] for i, v in rows}
    score = lambda a, b: sum(x * y for x, y in zip(whole[a], whole[b]))
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 0, k=5).collect()]
    best = sorted((i for i, _ in rows if i), key=lambda i: (-score(0, i), i))
    assert sorted(got) == [(0, n + 1, i, score(0, i)) for n, i in enumerate(best)] and [x[2] for x in sorted(got)][:4] == [50, 3, 2, 1]
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


def test_archives_of_other_writers(spark, tmp_path):
    """warcinfo, request, chunked and digest-less responses, metadata, a revisit of another crawl, a URL of 3 MB."""
    def sha1(data):
        return base64.b32encode(hashlib.sha1(data).digest()).decode()

    def record(kind, body, **fields):
        lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{kind}>", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items())]
        return "\r\n".join(["WARC/1.0", *lines, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"

    http, page = "application/http; msgtype=response", b"<p>body</p>"
    chunked = b"b\r\n<p>body</p>\r\n0\r\n\r\n"
    rows = [
        ("warcinfo", b"software: x\r\n\r\nformat: y", {"Content_Type": "application/warc-fields"}, b"software: x\r\n\r\nformat: y"),
        ("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", {"Content_Type": "application/http; msgtype=request"}, b""),
        ("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked, {"Content_Type": http, "WARC_Payload_Digest": "sha1:" + sha1(page)}, chunked),
        ("response", b"HTTP/1.1 200 OK\r\n\r\n" + page, {"Content_Type": http}, page),
        ("response", b"no header at all", {"Content_Type": http}, b"no header at all"),
        ("metadata", b"", {}, b""),
        ("response", b"HTTP/1.1 200 OK\r\n\r\n" + page, {"Content_Type": http, "WARC_Target_URI": "http://" + "u" * 3_000_000}, page)]
    revisit = ("revisit", b"HTTP/1.1 200 OK\r\n\r\n", {"Content_Type": http, "WARC_Payload_Digest": "sha1:" + sha1(page)})
    data = b"".join(record(k, b, **f) for k, b, f, *_ in [*rows, revisit])
    (tmp_path / "crawl.warc.gz").write_bytes(gzip.compress(data))
    manifest = spark.createDataFrame([(f"file://{tmp_path}/crawl.warc.gz",)], "file string")
    got = sorted(warc.read_records(warc.normalise(manifest), 3, True).collect(), key=lambda r: r.seq)
    assert [(r.record_type, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in got[:-1]] == [
        (k, len(p), sha1(p), p) for k, _, _, p in rows]
    assert (got[-1].record_type, got[-1].payload_bytes, got[-1].payload_digest, got[-1].payload) == ("revisit", None, sha1(page), None)
    (tmp_path / "bad.warc.gz").write_bytes(gzip.compress(record("response", b"HTTP/1.1 200 OK\r\n\r\nx", Content_Type=http, WARC_Payload_Digest="sha1:" + sha1(page))))
    bad = warc.normalise(spark.createDataFrame([(f"file://{tmp_path}/bad.warc.gz",)], "file string"))
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(bad).collect()

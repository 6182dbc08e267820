import base64
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import decontaminate, langid, pii

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(docs, items):
    windows = defaultdict(set)
    for key, text in items:
        w = norm(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i:i + 13])].add(key)
    out = []
    for key, text in docs:
        w, hit, found = norm(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (s := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[s]
        out.append((key, len(w), len(hit), len(found - {None}), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark, messy):
    texts = {r.doc_id: r.text for r in messy.collect()}
    cut = " ".join(texts[13].split()[5:40])
    rows = [(1, cut), (2, "ONE, two!"), (3, None), (4, ""), (5, "one"), (6, cut.upper()), (7, texts[16][:60]), (7, texts[16][:60]),
            (None, " ".join(texts[1].split()[:14])), (10, "no such words anywhere in here at all"), (11, "日本語 テキスト")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("seed", F.lit(0)).withColumn("n", F.lit(0))


@pytest.mark.parametrize("limit", [64 << 20, 2000])
def test_decontamination_equals_brute_force(messy, items, limit):
    got = decontaminate.contamination(decontaminate.find_hits(messy, items, max_broadcast_bytes=limit)).collect()
    want = brute_hits([(r.doc_id, r.text) for r in messy.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got], key=repr) == want
    assert sum(r.contaminated for r in got) > 5


def test_decontamination_empty_tables(messy, no_rows, items):
    assert decontaminate.find_hits(no_rows, items).count() == 0
    none = decontaminate.contamination(decontaminate.find_hits(messy, items.limit(0)))
    assert none.filter("contaminated or n_hit > 0").count() == 0 and none.count() == messy.count()


def test_remove_hit_words_judges_each_row_by_itself(spark, messy, items):
    left = {r.doc_id: r.text for r in decontaminate.remove_hit_words(messy.filter("doc_id in (9, 8, 100)"), items).collect()}
    assert left[9] == "" and left[8] == "" and len(left[100]) > 0
    leak = " ".join(f"leak{i}" for i in range(15))
    clean = " ".join(f"clean{i}" for i in range(20))
    docs = [(None, f"a {leak} b {leak} c"), (None, clean), (5, leak), (5, f"{clean} Leak3"), (6, None), (7, f"{leak} leak3"), (5, clean)]
    got = decontaminate.remove_hit_words(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                         spark.createDataFrame([(1, leak)], "item_id long, text string"))
    want = [(None, "a b c"), (None, clean), (5, ""), (5, f"{clean} leak3"), (6, ""), (7, "leak3"), (5, clean)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_benchmark_stage_judges_each_row_by_itself(spark, messy, items, tmp_path):
    import corpus_pipeline

    leak = items.filter("item_id = 1").first().text
    docs = spark.createDataFrame([(None, leak), (None, "a clean text"), (None, "other clean words"), (None, None),
                                  (1, leak), (1, "clean under the same id"), (2, "clean")], "doc_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.benchmark(spark, docs.repartition(3), str(tmp_path))
    want = [(r.doc_id, r.text) for r in docs.collect() if r.text != leak]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    # columns of the operator's own names, and several scans
    kept = decontaminate.drop_contaminated_rows(messy, items, max_broadcast_bytes=2000)
    bad = [x[-1] for x in brute_hits([(i, r.text) for i, r in enumerate(messy.collect())], [(r.item_id, r.text) for r in items.collect()])]
    assert kept.columns == messy.columns and kept.count() == len(bad) - sum(bad)


def test_decontamination_plan_is_native(messy, items):
    plan = decontaminate.find_hits(messy, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = np.random.default_rng(3)
    for _ in range(20_000):
        t = "".join(rng.choice(list("ab@..1234567890+-- ()é")) for _ in range(rng.integers(0, 50)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+" * 50_000 + "1 " * 50_000, "[at]" * 50_000, "(" * 100_000):
        base = pii.base_spans(t)
        pii.loose_spans(t, base)


PRIVATE = [
    (1, "write to jo.do@mail.example.com or call +1 (743) 555-3824 now"), (2, "card 4111 1111 1111 1111 and 4111-1111-1111-1112"),
    (3, "host 192.168.1.20 and 999.1.1.1 and 1.2.3.4.5.6.7.8"), (4, None), (5, ""), (5, ""), (None, "a@b.co"), (6, "mail me: jo [at] example [dot] org"),
    (7, "Grüße ünï@x.de +49 30 1234567 ü"), (8, "tel 555-123-4567 or (030) 123 4567"), (9, "version 1.2.3"), (10, "x" * 200_000 + " a@b.cd")]


def test_pii_tags_keep_base_spans_and_add_loose_ones(spark):
    df = spark.createDataFrame(PRIVATE * 3, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("kind", F.lit(1))
    model = pii.fit(pii.candidate_counts(df))
    got = pii.tag(df, model).collect()
    assert len(got) == len(PRIVATE) * 3
    texts = dict(PRIVATE)
    for r in got:
        base = plain_spans(texts[r.doc_id] or "")
        assert r.base == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
    assert "email:9:34" in next(r.spans for r in got if r.doc_id == 6)


def test_pii_redaction(spark):
    df = spark.createDataFrame(PRIVATE, "doc_id long, text string").withColumn("id", F.lit("clash"))
    model = pii.fit(pii.candidate_counts(df))
    out = pii.redact(df, model)
    assert out.schema == df.schema
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[1] == "write to [EMAIL] or call [PHONE] now" and text[4] is None and text[5] == "" and text[9] == "version 1.2.3"
    assert all(not pii.base_spans(t) for t in text.values() if t)


def test_pii_empty_table(spark, no_rows):
    counts = pii.candidate_counts(no_rows)
    assert counts == {} and pii.tag(no_rows, pii.fit(counts)).count() == 0


def test_em_recovers_a_reliable_labeler():
    rng = np.random.default_rng(0)
    patterns = defaultdict(int)
    for _ in range(4000):
        true = rng.random() < 0.6
        votes = tuple(int((1 if true else -1) * (1 if rng.random() < p else -1)) for p in (0.95, 0.8, 0.6))
        patterns[votes] += 1
    prior, rate, post = pii.reliabilities(dict(patterns))
    assert abs(prior - 0.6) < 0.1 and rate[0][1][1] > rate[1][1][1] > rate[2][1][1]
    assert post[1, 1, 1] > 0.9 and post[-1, -1, -1] < 0.1


SAMPLES = {"en": "the house with those things which were there and thought through them",
           "fr": "les maisons avec les choses qui étaient là et pensées à travers eux où",
           "de": "das haus mit den dingen welche dort waren und durch sie gedacht über",
           "es": "las casas con las cosas que estaban allí y pensadas a través de ellos ñ"}


@pytest.fixture(scope="module")
def spoken(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        lang = sorted(SAMPLES)[i % 4]
        w = SAMPLES[lang].split()
        rows.append((i, " ".join(rng.choice(w, rng.integers(3, 30))), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("label", F.lit("clash"))


def test_language_held_out_accuracy_and_rejection(spark, spoken):
    train = spoken.filter(~langid.held_out(F.col("doc_id")))
    model = langid.fit(train)
    test = langid.predict(spoken.filter(langid.held_out(F.col("doc_id"))), model).collect()
    assert sum(r.lang == r.lang_pred for r in test) > 0.97 * len(test)
    assert not any(r.rejected for r in test) and all(0 <= r.score <= 1 for r in test)
    odd = [None, "", "12 34 !", "漢字 日本語 テキスト", "THE HOUSE", "the " * 200_000]
    names, score, rejected = langid.predict_texts(model, odd)
    assert names[:3] == ["und"] * 3 and list(score[:3]) == [0, 0, 0]
    assert rejected.tolist() == [True, True, True, True, False, False] and names[4:] == ["en", "en"]


def test_language_rejects_odd_long_texts_in_spite_of_odd_training_rows(spark):
    rng = np.random.default_rng(7)

    def letters(n):
        return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(n))

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    labelled = docs.filter(~langid.held_out(F.col("doc_id"))).union(
        spark.createDataFrame([(10_000, letters(4), "en"), (10_001, letters(100), "fr")], docs.schema))
    model = langid.fit(labelled)
    blobs = [base64.b64encode(rng.bytes(900)).decode() for _ in range(20)]
    code = [open(f).read()[:3000] for f in (langid.__file__, decontaminate.__file__, pii.__file__)]
    _, _, rejected = langid.predict_texts(model, [letters(n) for n in (20, 100, 500) for _ in range(20)] + blobs + code)
    assert rejected.all()
    clean = [r.text for r in docs.filter(langid.held_out(F.col("doc_id"))).collect()]
    assert not langid.predict_texts(model, clean)[2].any()
    # a language left out of training
    _, _, foreign = langid.predict_texts(langid.fit(labelled.filter("lang <> 'es'")), [r.text for r in docs.filter("lang = 'es'").collect()])
    assert foreign.mean() > 0.8


def test_language_prediction_ignores_label_and_passes_columns(messy):
    model = langid.fit(messy)
    got = langid.predict(messy.withColumn("score", F.lit("old")), model)
    assert got.columns == [*messy.columns, "lang_pred", "score", "rejected"] and got.count() == messy.count()
    same = langid.predict(messy.withColumn("lang", F.lit("zz")), model)
    pick = ["doc_id", "lang_pred", "score"]
    assert sorted(map(repr, got.select(pick).collect())) == sorted(map(repr, same.select(pick).collect()))


def test_language_without_training_rows(messy, no_rows):
    model = langid.fit(no_rows)
    assert {r.lang_pred for r in langid.predict(messy, model).collect()} == {"und"}
    assert langid.predict(no_rows, model).count() == 0


def test_gram_counts_do_not_depend_on_the_piece(monkeypatch):
    text = "Ünder the  house, wíth 12 things -- and more of them " * 20
    whole = langid.gram_counts(text)
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(langid, "PIECE", size)
        assert (langid.gram_counts(text) == whole).all()

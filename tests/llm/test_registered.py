import duckdb
import pytest

import corpus_pipeline
from quire.llm import langid, pii
from quire.llm.queries import ORACLES, QUERIES
from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_queries_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[c] for c in cols)) for r in got.collect())


def test_simhash_query_equals_brute_force(spark):
    from test_dedup import brute_fingerprint, brute_groups

    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_groups(docs, 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, SF).collect()}
    assert got == {i: (f"{f:016x}", want[i]) for i, f in docs}


def test_language_query_learns(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = [r for r in QUERIES["op7_langid"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in got) > 0.95 * len(got) and not any(r.rejected for r in got)


def test_pii_query_equals_plain_patterns(spark):
    from test_filters import plain_spans

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op10_pii"](spark, SF).collect():
        base = {f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(texts[r.doc_id] or "")}
        assert base <= set(r.spans.split(",")) and len(base) == r.n_email + r.n_ip + r.n_card + r.n_phone


def test_token_and_mixing_queries_cover_all_documents(spark):
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in QUERIES["op4_token_counts"](spark, SF).collect()} == ids
    assert {r.doc_id for r in QUERIES["op8_mixing"](spark, SF).collect()} == ids


def test_pipeline_equals_its_operators_applied_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    model = langid.fit(docs.filter(~langid.held_out(docs.doc_id)))
    _, _, rejected = langid.predict_texts(model, [r.text for r in rows])
    rows = [r for r, x in zip(rows, rejected) if not x]
    from test_dedup import brute_fingerprint, brute_groups
    from test_filters import brute_hits, plain_spans

    groups = brute_groups([(r.doc_id, brute_fingerprint(r.text)) for r in rows], 3)
    rows = [r for r in rows if groups[r.doc_id] == r.doc_id]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {x[0] for x in brute_hits([(r.doc_id, r.text) for r in rows], items) if x[-1]}
    want = {r.doc_id for r in rows} - bad
    out = corpus_pipeline.run(spark, SF)
    got = out.collect()
    assert out.columns[:5] == docs.columns and {r.doc_id for r in got} == want and 0 < len(bad)
    assert not any(plain_spans(r.text) for r in got if r.text)
    assert all(r.n_chars == len(r.text) for r in got)


def test_pipeline_on_messy_documents(spark, messy, tmp_path):
    messy.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    named = [r.doc_id for r in got if r.doc_id is not None]
    assert 1 in named and 4 not in named and 8 not in named and len(got) > 30
    assert all(name in dict(corpus_pipeline.STAGES) for name in ("language", "near_duplicates", "benchmark", "personal_data", "mixture"))


def test_pipeline_on_empty_documents(spark, no_rows, tmp_path):
    no_rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

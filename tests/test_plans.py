"""Plan shape guards: the properties the scale design depends on."""

import re

from pyspark.sql import functions as F

from quire.operators import search as S
from quire.plans import fixtures
from quire.plans.indexing import build_index
from quire.session import work_path
from quire.sinks.index_store import (
    open_catalog_table, open_index_table, save_catalog_table, save_index_table,
)
from quire.operators.catalog import load_catalog
from quire.sources.books import books_from_table

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_build_never_shuffles_on_the_book_alone(spark):
    plan = _plan(build_index(books_from_table(spark.read.parquet(f"{SF}/documents.parquet"))))
    keys = _hash_exchanges(plan)
    assert keys and all("word" in k for k in keys)


def test_batch_search_over_stored_tables_moves_only_request_sized_data(spark):
    """No table of the index is under an exchange, and declaring a search starts no job."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    idx, cat = work_path(spark, "pl-index"), work_path(spark, "pl-cat")
    save_index_table(build_index(books_from_table(docs)), idx, 8)
    save_catalog_table(load_catalog(fixtures.catalog_lines(docs)), cat, 8)
    index, catalog = open_index_table(spark, idx), open_catalog_table(spark, cat)
    spark.sparkContext.setJobGroup("declared", "no job may start here")
    df = S.search_batch(index, fixtures.title_requests(docs), catalog)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("declared")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet spark_catalog[^\n]*", plan)
    assert len(scans) >= 5 and all("Bucketed: true" in s for s in scans)
    # walk the tree: an exchange must not lead straight to a stored table (a join lies between)
    lines = plan.split("\n")
    depth = [len(re.match(r"[\s:+|*()0-9-]*", line)[0]) for line in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line:
            continue
        for j in range(i + 1, len(lines)):
            if depth[j] <= depth[i] or "Join" in lines[j]:
                break
            assert "FileScan parquet spark_catalog" not in lines[j], plan


def test_same_search_plan_at_every_size(spark):
    """No size switch: the plan of few and of many requests differs in nothing but its input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    idx = work_path(spark, "pl-same")
    save_index_table(build_index(books_from_table(docs)), idx, 8)
    index = open_index_table(spark, idx)
    shapes = []
    for n in (1, 200_000):
        req = spark.range(n).selectExpr("id AS query_id", "array('en', 'er') AS words")
        plan = S.search_batch(index, req)._jdf.queryExecution().executedPlan().toString()
        shapes.append(re.findall(r"[A-Z][A-Za-z]*(?:Join|Exchange|Aggregate|Scan)|hashpartitioning", plan))
    assert shapes[0] == shapes[1] and shapes[0]


def test_literal_search_reads_the_files_of_its_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    idx = work_path(spark, "pl-literal")
    save_index_table(build_index(books_from_table(docs)), idx, 16)
    index = open_index_table(spark, idx)
    assert 1 <= len(index.find(["en"]).inputFiles()) <= 3
    plan = _plan(S.search(spark, index, ["en", "er"]))
    assert re.search(r"PushedFilters: \[[^\]]*In\(word", plan) and "Bucketed: true" not in plan


def _regexps(df):
    return len(re.findall(r"(?i)regexp_|rlike", df._jdf.queryExecution().optimizedPlan().toString()))


def test_extraction_computes_each_step_once(spark):
    from quire.functions.html import body_text
    from quire.plans.crawling import extract_book_records
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert _regexps(pages.select(body_text("html").alias("t"))) <= 10
    records = extract_book_records(pages.select(F.col("url").alias("href"), "html"))
    assert _regexps(records) <= 60

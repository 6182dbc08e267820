"""Corpus pipeline: documents in, a training mixture out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, langid, mixing, pii, simhash
from quire.llm.common import staged
from quire.session import table_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that no language's centroids accept; nothing else changes."""
    train = docs.filter(~langid.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    return langid.predict(docs, langid.fit(train)).filter("not rejected").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every SimHash group: the smallest id, rows without id last."""
    return simhash.one_row_a_group(docs, shingle=3, radius=3).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark passages, each row judged by itself."""
    items = spark.read.parquet(table_path(sf_dir, "benchmark"))
    return decontaminate.drop_contaminated_rows(docs, items).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; n_chars follows."""
    clean = pii.redact(docs, pii.fit(pii.candidate_counts(docs)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return clean.select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the documents into blocks by flattened source weights, none left out."""
    return mixing.mix(docs, max_repetition=2.0)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: a language model, fingerprints and a label model are not SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

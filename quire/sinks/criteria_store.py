"""Stored n-gram index of the catalogue's text criteria (see quire.operators.criteria)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.operators.criteria import (
    GRAMS_SCHEMA, VALUES_SCHEMA, CriteriaIndex, field_values, value_grams,
)
from quire.sinks.index_store import _commit, _last


def save_criteria_index(catalog: DataFrame, path: str, slots: int) -> str:
    """Write the values and grams of ``catalog`` as a new version at ``path``; returns the version.
    Both are cut into ranges, so a value that most books share, or a frequent gram, is
    several files of its slot."""
    spark = catalog.sparkSession
    version = "v-" + uuid.uuid4().hex
    folder = f"{path}/{version}"
    _write(field_values(catalog, slots), f"{folder}/values", slots, ["field", "slot", "key", "book_id"])
    values = spark.read.schema(VALUES_SCHEMA).parquet(f"{folder}/values")
    _write(value_grams(values, slots), f"{folder}/grams", slots, ["field", "slot", "gram", "key"])
    _commit(spark, path, version, slots)
    return version


def _write(df: DataFrame, folder: str, files: int, order: list[str]) -> None:
    (df.repartitionByRange(files, *order).sortWithinPartitions(*order)
     .write.partitionBy("field", "slot").parquet(folder))


def open_criteria_index(spark: SparkSession, path: str) -> CriteriaIndex:
    """The last committed index at ``path``."""
    last = _last(spark, path, None)
    read = lambda schema, part: spark.read.schema(schema).parquet(f"{path}/{last['version']}/{part}")
    return CriteriaIndex(read(VALUES_SCHEMA, "values"), read(GRAMS_SCHEMA, "grams"), last["buckets"])

"""Catalogue (metadata) lines from append-only text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_catalog_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) with ``line_no`` increasing in append order.

    Files are split and read in parallel; the order key is (file modification time, file
    path, block start, row id within the task), which follows the order lines were
    appended without reading any file in one piece.
    """
    df = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_modification_time").alias("_mtime"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))
    return df.select(F.struct("_mtime", "_file", "_block", "_row").alias("line_no"), "line")

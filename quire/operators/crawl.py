"""Crawl frontier: listing-page start indexes and the pages still to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.constants import FRONTIER_FIRST, FRONTIER_LAST, FRONTIER_STEP


def frontier(spark: SparkSession, first: int = FRONTIER_FIRST, last: int = FRONTIER_LAST,
             step: int = FRONTIER_STEP) -> DataFrame:
    """(page INT, claimed BOOLEAN): every listing start index, none claimed yet."""
    return spark.range(first, last + 1, step).select(
        F.col("id").cast("int").alias("page"), F.lit(False).alias("claimed"))


def frontier_of(listing: DataFrame, step: int = FRONTIER_STEP) -> DataFrame:
    """Frontier covering the listing pages of a catalogue: 0, step, ... up to the last
    listing start index present (gaps included, like the fixed range).  Only that one
    scalar bound reaches the driver; the pages are generated by a distributed range."""
    last = listing.agg(F.max("start_index")).first()[0]
    if last is None:
        return frontier(listing.sparkSession, 0, -1, step)
    return frontier(listing.sparkSession, 0, int(last), step)


def pending_pages(front: DataFrame, processed: DataFrame) -> DataFrame:
    """Unclaimed pages that are not in the processed ledger (each page handed out once)."""
    return front.filter(~F.col("claimed")).join(
        processed.select("page"), "page", "left_anti")

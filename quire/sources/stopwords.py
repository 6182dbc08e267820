"""Stopword list: the bundled fixed list, or a text file of one word per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.constants import STOPWORDS


def stopword_list() -> tuple[str, ...]:
    return STOPWORDS


def stopwords_frame(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(word) — trimmed, lower-cased, distinct.  Without ``path`` the bundled list."""
    if path is None:
        return spark.createDataFrame([(w,) for w in STOPWORDS], "word STRING")
    return (spark.read.text(path).select(F.lower(F.trim("value")).alias("word"))
            .distinct())

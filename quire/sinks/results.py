"""Search results as JSON objects ``{"bookId": …, "positions": {word: [pos, …]}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def result_json(book_id="book_id", positions="positions") -> Column:
    b = F.col(book_id) if isinstance(book_id, str) else book_id
    p = F.col(positions) if isinstance(positions, str) else positions
    return F.to_json(F.struct(b.alias("bookId"), p.alias("positions")))


def write_results_json(results: DataFrame, path: str) -> None:
    """JSON lines, one result object per line, partitioned by the writing tasks (the
    ``{"results": [...]}`` envelope is a concatenation of these lines)."""
    (results.select("query_id", F.col("book_id").alias("bookId"), "positions").write.mode("overwrite").json(path))

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import work_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage in a place every executor can read, so a lost executor costs no
    recomputation of what came before, and what is used twice is computed once."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` staged with a number for each row, and the name of that new column.

    The numbers are written with the rows, so every read sees the same ones."""
    row, taken = "row_number_", {c.lower() for c in df.columns}
    while row in taken:
        row += "_"
    return staged(df.withColumn(row, F.monotonically_increasing_id()), name), row


def _reads_files(df: DataFrame) -> bool:
    """Whether ``df`` is a selection of rows and columns of one file table, and nothing else."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.children().isEmpty() and "Relation" in plan.nodeName()


def identified(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` with a column that tells its rows apart, and the name of that column.

    Rows of a file table have a place that every read sees alike: (hash of the file's path, row
    in the file), so nothing is copied.  Others are numbered by :func:`numbered`."""
    if not _reads_files(df) or df.schema.simpleString().find("_metadata") >= 0:
        return numbered(df, name)
    row, taken = "row_number_", {c.lower() for c in df.columns}
    while row in taken:
        row += "_"
    try:
        place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        return df.select("*", place.alias(row)), row
    except AnalysisException:                     # a format without row numbers
        return numbered(df, name)


#: row numbers broadcast to drop rows, at most; about 16 bytes each
MAX_BROADCAST_ROWS = 2_000_000


def without(rows: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """``rows`` but for those numbered in ``gone`` (a column ``row``, no number twice).

    The numbers are written and counted first.  Few enough are broadcast, so no text moves;
    more meet the rows in a shuffle."""
    gone = staged(gone, "gone")
    if gone.count() <= MAX_BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return rows.join(gone, row, "left_anti")


def texts_as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column (null stays None)."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 20,
           most_rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut Arrow batches so that a slice holds about ``most_bytes`` of text.

    A longer text is a slice of its own, so memory follows the longest text, not the
    number of rows that happened to arrive together."""
    for batch in batches:
        texts = texts_as_bytes(batch.column(column))
        at = size = 0
        for i, text in enumerate(texts):
            n = len(text) if text else 0
            if i > at and (size + n > most_bytes or i - at >= most_rows):
                yield batch.slice(at, i - at), texts[at:i]
                at, size = i, 0
            size += n
        if at < len(texts):
            yield batch.slice(at), texts[at:]


def digest_hex(column) -> F.Column:
    """Sixteen lowercase hex digits of a long read as unsigned."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))

"""Book sources.

* a table with an id and a text column (the driver's ``documents``), or
* a directory of ``<id>.txt`` files, read with one row per file.
Both give ``(doc_key STRING, book_id BIGINT, text STRING)``; ``doc_key`` is the digit
string the ledger tracks, ``book_id`` the integer the index uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import book_id_from_path, doc_key_from_path, normalize_separators


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def books_from_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Books from a table whose id column is an integer key."""
    return df.select(F.col(id_col).cast("string").alias("doc_key"),
                     F.col(id_col).cast("bigint").alias("book_id"),
                     F.col(text_col).alias("text"))


def list_books(spark: SparkSession, directory: str) -> DataFrame:
    """(path) of the regular files directly in ``directory`` (not recursive), with '/'
    separators; an empty listing when the directory does not exist."""
    if not _is_directory(spark, directory):
        return spark.createDataFrame([], "path STRING")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "false")
             .load(directory).select("path"))
    return files.select(normalize_separators("path").alias("path"))


def _is_directory(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory()


def books_from_files(spark: SparkSession, directory: str) -> DataFrame:
    """One row per text file of ``directory``: (path, doc_key, book_id, text).

    Files whose name has no digits (or whose digits overflow an INT) are not books and
    are dropped here.  Each file is one row, read as a whole (a book is the unit of
    tokenization and of the ledger).
    """
    raw = spark.read.text(directory, wholetext=True).select(
        normalize_separators(F.col("_metadata.file_path")).alias("path"),
        F.col("value").alias("text"))
    return (raw.select("path", doc_key_from_path("path").alias("doc_key"),
                       book_id_from_path("path").alias("book_id"), "text")
            .filter((F.col("doc_key") != "") & F.col("book_id").isNotNull()))

"""Stored forward index: a Parquet table bucketed by the cell of (book_id, block)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import tokenize
from quire.operators.forward import FORWARD_SCHEMA, cell_of, fragments, token_blocks
from quire.operators.sizing import spread
from quire.sinks.index_store import _commit, _last, _open_bucketed, _table_name, save_bucketed

_SORT, _BY = ["cell", "book_id", "block"], ("cell",)


def save_forward_table(books: DataFrame, path: str, buckets: int, tokenizer=tokenize) -> str:
    """Write the token blocks of ``books`` (book_id, text) as a new version at ``path``.  Equal
    copies of a book are stored once; they meet where the buckets are made, block by block."""
    blocks = token_blocks(spread(books.select("book_id", "text")), tokenizer)
    once = blocks.repartition(buckets, "cell").dropDuplicates(["cell", "book_id", "block", "version"])
    version = "v-" + uuid.uuid4().hex
    name = save_bucketed(once, f"{path}/{version}/forward", buckets, _SORT, _table_name("quire_forward", path, version), by=_BY)
    _commit(books.sparkSession, path, version, buckets)
    return name


def open_forward_table(spark: SparkSession, path: str) -> DataFrame:
    """The last committed forward index."""
    return _open_bucketed(spark, path, _last(spark, path, None), FORWARD_SCHEMA, _SORT, "forward", "quire_forward", _BY)


def fragment_at(spark: SparkSession, path: str, book_id: int, pos: int, radius: int = 5) -> DataFrame:
    """(book_id, pos, fragment) of one literal place: only the buckets of its blocks are opened."""
    from quire.operators.forward import BLOCK
    wanted = range(max(pos - radius, 0) // BLOCK, (max(pos, 0) + radius) // BLOCK + 1)
    cells = spark.range(1).select(*[cell_of(F.lit(book_id), F.lit(b)).alias(f"c{b}") for b in wanted]).first()
    near = open_forward_table(spark, path).filter(F.col("cell").isin(list(cells)))
    return fragments(near, spark.createDataFrame([(book_id, pos)], "book_id BIGINT, pos INT"), radius)

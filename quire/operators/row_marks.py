"""Rows of a file table marked by their place, so that wide rows are chosen without being moved.

The places (file, row in the file) of the wanted rows are found from narrow columns alone.  They are
kept as bitmaps of 256 rows (quire.operators.word_blocks), dealt into slices of whole files, and every slice
is broadcast to the scan of its own files.  All slices together read every wanted file once, and no
wide column is ever under an exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.word_blocks import BLOCK_BITS, LANES, word_blocks

FILE, ROW = "_source_file", "_source_row"
#: bitmaps broadcast at once, some 100 bytes each; they stand for 256 rows apiece
SLICE_BLOCKS = 400_000


def with_places(df: DataFrame) -> DataFrame | None:
    """``df`` with the file and row each of its rows comes from; None unless it is a selection of
    rows and columns of one file table whose format numbers its rows (Parquet does)."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return None
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if not plan.children().isEmpty() or "Relation" not in plan.nodeName():
        return None
    try:
        return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
    except AnalysisException:
        return None


def slices_of(per_file: list[tuple[str, int]], bound: int = SLICE_BLOCKS) -> list[list[str]]:
    """Files with their numbers of bitmaps, dealt in order into slices of at most ``bound`` bitmaps
    (a file beyond the bound is a slice of its own)."""
    slices, room = [], 0
    for file, n in per_file:
        if not slices or n > room:
            slices.append([])
            room = bound
        slices[-1].append(file)
        room -= n
    return slices


def marked_rows(placed: DataFrame, marks: DataFrame, bound: int = SLICE_BLOCKS) -> DataFrame:
    """The rows of ``placed`` (see :func:`with_places`) whose place is in the bitmaps ``marks``.

    ``marks`` is stored (it is read for each slice).  One number for each file with a wanted row
    comes to the driver, which lists these files anyway to plan their scan."""
    per_file = [(r["word"], r["n"]) for r in marks.groupBy("word").agg(F.count("*").alias("n")).orderBy("word").collect()]
    sizes = dict(per_file)
    row, parts = F.col(ROW), []
    for files in slices_of(per_file, bound):
        held = marks.filter(F.col("word").isin(files)).select(F.col("word").alias(FILE), F.col("block").alias("_block"), *[
            F.col(m).alias(f"_{m}") for m in LANES])
        held = F.broadcast(held) if sum(sizes[f] for f in files) <= bound else held
        near = placed.filter(F.col(FILE).isin(files)).withColumn("_block", F.shiftright(row, BLOCK_BITS))
        lane = F.shiftright(row, 6).bitwiseAND(F.lit(3)).cast("int")
        mask = F.element_at(F.array(*[F.col(f"_{m}") for m in LANES]), lane + 1)
        bit = F.call_function("shiftrightunsigned", mask, row.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
        parts.append(near.join(held, [FILE, "_block"]).filter(bit == 1).select(*placed.columns))
    return reduce(DataFrame.unionByName, parts) if parts else placed.filter("false")


def marks_of(places: DataFrame) -> DataFrame:
    """Bitmaps of places (file, row)."""
    return word_blocks(places.select(F.col(FILE).alias("word"), F.col(ROW).alias("book_id")))

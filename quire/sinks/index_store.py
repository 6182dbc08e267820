"""Index and ledger tables as Parquet folders (append-only, ledger written last).

Incremental runs write their postings under their own partition ``run=<id>`` and then
append ``(doc_key, run)`` rows to the ledger.  The ledger is the commit record: readers
open only the runs it lists, or the segments they were merged into (quire.sinks.run_levels), so postings
of a run whose ledger write never happened (a failed or replayed batch) are invisible, and nothing is counted twice.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.metadata import release_year
from quire.operators.ledger import LEDGER_SCHEMA
from quire.operators.postings import DELTA_CODED, POSTINGS_SCHEMA, merge_postings
from quire.operators.search import SearchIndex
from quire.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, collect_if_small, deal, has_at_most
from quire.operators.word_blocks import BLOCKS_SCHEMA, parts_for, word_blocks, word_counts
from quire.session import released_shuffles, rely_on_buckets, sorted_scans
from quire.sinks.commit_log import append_entry, last_entry
from quire.sinks.run_levels import folder_of, live_folders, read_folders


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder under its declared schema; without rows when the folder is missing,
    holds no data file yet, or was left behind by a failed write."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def new_run_id() -> str:
    return "r-" + uuid.uuid4().hex


def write_run(postings: DataFrame, path: str, run: str) -> None:
    """Append one run's postings under ``path/run=<run>``, sorted by (word, book_id)."""
    with released_shuffles(postings.sparkSession), sorted_scans(postings.sparkSession):
        (postings.select("word", "book_id", "positions").sortWithinPartitions("word", "book_id")
         .write.mode("append").parquet(folder_of(path, run)))


def read_postings(spark: SparkSession, path: str, ledger_path: str | None = None,
                  merge: bool = False, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Postings of an index folder.

    With ``ledger_path``: only committed runs are read, and only books indexed more than
    once — under several keys (``007.txt`` and ``7.txt`` are both book 7) or by several
    runs (two jobs that indexed the same key side by side) — have their positions merged.
    They are found from the ledger alone, so the rest of the index is read as written; if they are too
    many to broadcast, all rows are dealt by book once, to be told apart and merged where they are then.
    Without it, ``merge=True`` set-merges every (word, book_id) of all folders there are.

    Only live folders are opened: the segments of the last merge and the committed runs that wait
    for one (quire.sinks.run_levels), fewer than FAN a level where runs are merged.
    """
    if ledger_path is None:
        df = read_folder(spark, path, POSTINGS_SCHEMA + ", run STRING").select("word", "book_id", "positions")
        return merge_postings(df) if merge else df
    ledger = read_ledger(spark, ledger_path)
    df = read_folders(spark, live_folders(spark, path, ledger))
    keys = ledger.select(F.col("doc_key").try_cast("int").cast("bigint").alias("book_id"),
                         "doc_key", "run").filter(F.col("book_id").isNotNull()).distinct()
    multi = keys.groupBy("book_id").count().filter(F.col("count") > 1).select("book_id")
    if collect_if_small(multi, 0) is not None:      # every book was indexed once
        return df
    if has_at_most(multi, max_broadcast_rows):
        once, again = [df.join(F.broadcast(multi), "book_id", how) for how in ("left_anti", "left_semi")]
        return once.unionByName(merge_postings(again)).select("word", "book_id", "positions")
    books = deal(multi.select("book_id", F.lit(True).alias("_multi")), "book_id", like=df)
    marked = deal(df, "book_id").join(books.hint("shuffle_hash"), "book_id", "left")
    once = marked.filter(F.col("_multi").isNull()).select("word", "book_id", "positions")
    return once.unionByName(merge_postings(marked.filter("_multi"), dealt=True))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger of indexed keys; an empty table with the ledger schema before the first run."""
    return read_folder(spark, path, LEDGER_SCHEMA)


def append_ledger(keys: DataFrame, path: str, run: str | None = None) -> None:
    """Append (doc_key, run) rows: the commit record of a run (written after its data)."""
    keys.select(F.col("doc_key").cast("string"),
                F.lit(run).cast("string").alias("run")).write.mode("append").parquet(path)


# ---- document-partitioned index table --------------------------------------------------
#
# The index is stored as a Parquet table bucketed by book_id and sorted by (word,
# book_id) inside each bucket.  A bucket holds every posting of its books, so a search
# (division per (query, book), criteria per book, positions per (word, book)) runs
# inside the buckets: the index is never shuffled by a query.  Needs
# spark.sql.requireAllClusterKeysForCoPartition=false so joins on (word, book_id) accept
# the book_id bucketing.  Bucketing happens after aggregation, where one book is at most
# its vocabulary, so a book delivered in many copies cannot make a bucket hot.
#
# Beside it a version holds what finds books by word:
#   blocks    bitmaps (quire.operators.word_blocks), bucketed by (word, part)
#   words     (word, n_books), bucketed by word
#   by_word   the postings again, range-partitioned and sorted by (word, book_id), so that a
#             frequent word is cut into ranges of books, one file a range
#   files     the directory of by_word: first and last (word, book_id) of every file
# A lookup of literal words reads the directory and opens only the files that can hold them.
#
# A stored table is a folder of versions.  Each save writes a new version and then appends one
# entry (version, buckets, parts) to the log ``commits`` (quire.sinks.commit_log): that entry commits
# the save, all its tables together, and tells readers the bucket and part counts.  Of two saves at
# the same time each gets an entry, and the later one is current.

FILES_SCHEMA = "file STRING, first STRUCT<word: STRING, book_id: BIGINT>, last STRUCT<word: STRING, book_id: BIGINT>, n BIGINT"


def _sql_string(text: str) -> str:
    """Escape a value for a single-quoted Spark SQL string literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _table_name(prefix: str, path: str, version: str) -> str:
    """The same name each time one version is opened, so reopening adds no table."""
    return f"{prefix}_{hashlib.sha1(f'{path}/{version}'.encode()).hexdigest()[:16]}"


def current_version(spark: SparkSession, path: str) -> dict | None:
    """version, buckets, number and parts of the last committed save at ``path``, or None."""
    last = last_entry(spark, f"{path}/commits")
    return {"number": last[0], **last[1]} if last else None


def _commit(spark: SparkSession, path: str, version: str, buckets: int, parts: int | None = None) -> None:
    last = current_version(spark, path)
    number = 1 if last is None else last["number"] + 1
    while not append_entry(spark, f"{path}/commits", number, {"version": version, "buckets": buckets, "parts": parts}):
        number += 1


def save_bucketed(df: DataFrame, path: str, buckets: int, sort_cols: list[str],
                  name: str, bloom_col: str | None = None, by: tuple[str, ...] = ("book_id",),
                  dealt: bool = False) -> str:
    """Write ``df`` as a Parquet table bucketed by ``by`` (one file per bucket, sorted by
    ``sort_cols`` inside it) at ``path``; returns the table name.  ``bloom_col`` gets a
    Parquet bloom filter, so equality / IN filters on it skip row groups.  ``dealt``: the rows are in
    ``buckets`` partitions by ``by`` already."""
    writer = ((df if dealt else df.repartition(buckets, *by)).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, *by).sortBy(*sort_cols).option("path", path))
    if bloom_col:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom_col}", "true")
    with released_shuffles(df.sparkSession):
        writer.saveAsTable(name)
    return name


def _last(spark: SparkSession, path: str, buckets: int | None):
    """The last committed save at ``path``; ValueError if there is none or its buckets differ."""
    last = current_version(spark, path)
    if last is None:
        raise ValueError(f"no committed table at {path}")
    if buckets is not None and buckets != last["buckets"]:
        raise ValueError(f"{path} has {last['buckets']} buckets, not {buckets}")
    return last


def _open_bucketed(spark: SparkSession, path: str, last, schema: str, sort_cols: list[str],
                   part: str, prefix: str, by: tuple[str, ...] = ("book_id",)) -> DataFrame:
    rely_on_buckets(spark)
    name = _table_name(prefix, path, last["version"])
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({', '.join(by)}) "
                  f"SORTED BY ({', '.join(sort_cols)}) INTO {last['buckets']} BUCKETS "
                  f"LOCATION '{_sql_string(path + '/' + last['version'] + '/' + part)}'")
    return spark.table(name)


_INDEX_SORT = ["word", "book_id"]
_BLOCKS_SORT, _BLOCKS_BY = ["word", "block"], ("word", "part")


def _save_by_word(postings: DataFrame, folder: str, files: int) -> None:
    """The postings in ``files`` ranges of (word, book_id), and the directory of their files."""
    spark = postings.sparkSession
    key = F.struct("word", "book_id")
    with released_shuffles(spark):
        (postings.repartitionByRange(files, "word", "book_id").sortWithinPartitions("word", "book_id")
         .write.options(**DELTA_CODED).parquet(f"{folder}/by_word"))
        (spark.read.schema(POSTINGS_SCHEMA).parquet(f"{folder}/by_word")
         .groupBy(F.col("_metadata.file_name").alias("file"))
         .agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n"))
         .coalesce(1).write.parquet(f"{folder}/files"))


def word_files(spark: SparkSession, folder: str, words: list[str], book_id: int | None = None) -> list[str]:
    """Files of by_word that can hold a posting of ``words`` (in one book, if given)."""
    book = lambda end: F.col(f"{end}.book_id") if book_id is None else F.lit(book_id).cast("bigint")
    at = lambda end: F.struct(F.col("w").alias("word"), book(end).alias("book_id"))
    files = spark.read.schema(FILES_SCHEMA).parquet(f"{folder}/files").withColumn(
        "w", F.explode(F.array(*[F.lit(w) for w in words]).cast("array<string>")))
    hit = files.filter((F.col("first") <= at("first")) & (F.col("last") >= at("last")))
    return sorted(f"{folder}/by_word/{r.file}" for r in hit.select("file").distinct().collect())


def word_postings(spark: SparkSession, folder: str, words: list[str], book_id: int | None = None) -> DataFrame:
    """Postings of literal words (in one book, if given), read from only those files."""
    names = [w for w in words if w is not None]
    files = word_files(spark, folder, names, book_id) if names else []
    if not files:
        return spark.createDataFrame([], POSTINGS_SCHEMA)
    found = spark.read.schema(POSTINGS_SCHEMA).parquet(*files).filter(F.col("word").isin(names))
    return found if book_id is None else found.filter(F.col("book_id") == book_id)


def save_index_table(postings: DataFrame, path: str, buckets: int) -> str:
    """Write postings as a bucketed table (one file per bucket), and the tables that find books
    by word, as a new version of the index at ``path``; returns the table name."""
    spark = postings.sparkSession
    version = "v-" + uuid.uuid4().hex
    folder = f"{path}/{version}"
    name = save_bucketed(postings.select("word", "book_id", "positions"), f"{folder}/postings", buckets,
                         _INDEX_SORT, _table_name("quire_index", path, version), bloom_col="word")
    stored = spark.table(name)
    with released_shuffles(spark):
        first, last = stored.agg(F.min("book_id"), F.max("book_id")).first()
    parts = 1 if first is None else parts_for(first, last)
    blocks = save_bucketed(word_blocks(stored, parts, buckets), f"{folder}/blocks", buckets, _BLOCKS_SORT,
                           _table_name("quire_blocks", path, version), by=_BLOCKS_BY, dealt=True)
    save_bucketed(word_counts(spark.table(blocks)), f"{folder}/words", buckets, ["word"],
                  _table_name("quire_words", path, version), by=("word",))
    _save_by_word(stored, folder, buckets)
    _commit(spark, path, version, buckets, parts)
    return name


def open_index_table(spark: SparkSession, path: str, buckets: int | None = None) -> SearchIndex:
    """The last committed save.  The bucket count comes from the table itself; a ``buckets``
    that differs raises ValueError."""
    last = _last(spark, path, buckets)
    opened = lambda schema, sort, part, by: _open_bucketed(
        spark, path, last, schema, sort, part, f"quire_{'index' if part == 'postings' else part}", by)
    return SearchIndex(opened(POSTINGS_SCHEMA, _INDEX_SORT, "postings", ("book_id",)),
                       opened(BLOCKS_SCHEMA, _BLOCKS_SORT, "blocks", _BLOCKS_BY),
                       opened("word STRING, n_books BIGINT", ["word"], "words", ("word",)), last["parts"],
                       lambda words: word_postings(spark, f"{path}/{last['version']}", words))


CATALOG_SCHEMA = ("book_id BIGINT, title STRING, author STRING, date STRING, language STRING, "
                  "year INT")


def save_catalog_table(catalog: DataFrame, path: str, buckets: int) -> str:
    """Store the parsed catalogue bucketed like the index, so the criteria join of a
    search is bucket to bucket and no query re-parses or shuffles the catalogue.  The
    release year is parsed once, here; a literal year bound reaches the scan."""
    version = "v-" + uuid.uuid4().hex
    name = save_bucketed(
        catalog.select("book_id", "title", "author", "date", "language",
                       release_year("date").cast("int").alias("year")),
        f"{path}/{version}/catalog", buckets, ["book_id"],
        _table_name("quire_catalog", path, version))
    _commit(catalog.sparkSession, path, version, buckets)
    return name


def open_catalog_table(spark: SparkSession, path: str, buckets: int | None = None) -> DataFrame:
    """The last committed catalogue; bucket count as in :func:`open_index_table`."""
    return _open_bucketed(spark, path, _last(spark, path, buckets), CATALOG_SCHEMA, ["book_id"], "catalog",
                          "quire_catalog")

"""Continuous indexing with Structured Streaming.

A file source watches the folder where fetched books land (Parquet files of
``doc_key, book_id, text``).  Each micro-batch runs the incremental index job:
anti-join the ledger, append postings, append the ledger last.  A replayed batch
(after a failure between the postings write and the checkpoint commit) finds its keys
either absent from the ledger — and is indexed again, which the set-union merge of
positions makes harmless — or present, and is skipped.  Copies of one key inside a batch
collapse in the set aggregation of positions (only the ledger keys are made distinct);
no streaming dedup state is kept, so state does not grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.plans.indexing import index_new_books
from quire.sinks.index_store import read_ledger
from quire.sinks.run_levels import FAN, merge_runs

#: files of one micro-batch
MAX_FILES_PER_TRIGGER = 1000

BOOK_FILE_SCHEMA = "doc_key STRING, book_id BIGINT, text STRING"


def book_stream(spark: SparkSession, source_dir: str,
                max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    return (spark.readStream.schema(BOOK_FILE_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))


def start_stream_index(spark: SparkSession, source_dir: str, index_path: str,
                       ledger_path: str, checkpoint: str, available_now: bool = True,
                       max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                       partitions: int | None = None, fan: int = FAN) -> StreamingQuery:
    """Start the ingest query; with ``available_now`` it drains what is there and stops.
    The runs of its micro-batches are merged level by level, ``fan`` at a time."""
    def index_batch(batch: DataFrame, batch_id: int) -> None:
        index_new_books(batch, index_path, ledger_path, partitions=partitions)
        merge_runs(spark, index_path, read_ledger(spark, ledger_path), fan)

    writer = (book_stream(spark, source_dir, max_files_per_trigger).writeStream
              .foreachBatch(index_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="10 seconds")
    return writer.start()

"""Token counts of documents in flat, unindexed token files by a separator scan.

A token file is nothing but fixed-width token ids, documents one after another, each ended
by an end-of-document id.  Files are cut into blocks of equal size; a task reads its block
and finds the separators with one vectorised comparison.  A document's length is the
distance between two separators, which may lie in different blocks: a prefix scan over the
block summaries (separators so far, last separator so far) carries both across block edges.
Only summaries go through the scan's window; the separators join back by block.

A last document without a separator is reported with ``terminated`` false; empty documents
(two separators in a row) have length 0; an empty file gives no rows.  A document may span
any number of blocks.  Files are read by range, so memory is one block, and by URI, so any
shared store that pyarrow can open will do.

``write_token_files`` makes such files from a table of texts and returns which document is
where.  Null texts are empty; rows may repeat; an empty table gives no files.
"""

from __future__ import annotations

import base64
import functools
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import slices, staged
from quire.session import work_path

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EOD = 50_256
DTYPE = "<u2"
BLOCK_TOKENS = 1 << 21
#: characters encoded in one call; longer texts are cut before a space
PIECE = 1 << 16


@functools.cache
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str) -> list[str]:
    """The text in pieces that start at a single space between two letters, where the
    pattern always splits; so their tokens are the tokens of the text."""
    out, at = [], 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1:cut + 2].isalpha()):
            cut += 1
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def encode(text: str, path: str, dtype: str = DTYPE) -> np.ndarray:
    code = _encoding(path)
    return np.concatenate([np.array(code.encode_ordinary(p), dtype) for p in pieces(text)])


def write_token_files(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS,
                      eod: int = EOD, dtype: str = DTYPE) -> DataFrame:
    """Write one file a task; (file, doc, key): document number ``doc`` of ``file`` is ``key``.

    A file's name is new for every attempt, and only files of attempts that Spark committed
    are in the returned (written) table."""
    root = work_path(docs.sparkSession, "tokens")
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def written(batches):
        store, path = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        store.create_dir(path, recursive=True)
        name, out, doc = f"{uuid.uuid4().hex}.bin", None, 0
        for part, texts in slices(batches, "text"):
            out = out or store.open_output_stream(f"{path}/{name}", compression=None)
            for t in texts:
                out.write(np.append(encode(t.decode(), ranks, dtype), np.array(eod, dtype)).astype(dtype).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{root}/{name}"] * len(texts)), pa.array(np.arange(doc, doc + len(texts))), part.column("id")],
                ["file", "doc", "id"])
            doc += len(texts)
        if out:
            out.close()

    return staged(rows.mapInArrow(written, f"file string, doc bigint, id {kind}"), "token-manifest").withColumnRenamed("id", key)


def _open(uri: str):
    store, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return store.open_input_file(path)


def scan_separators(files: DataFrame, eod: int = EOD, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, doc, start, n_tokens, terminated): every document of every file in ``files(file)``."""
    width = np.dtype(dtype).itemsize

    def sized(batches):
        for batch in batches:
            sizes = []
            for uri in batch.column("file").to_pylist():
                with _open(uri) as f:
                    sizes.append(f.size() // width)
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(sizes, pa.int64())], ["file", "tokens"])

    names = files.select("file").filter("file is not null").distinct()
    lengths = staged(names.mapInArrow(sized, "file string, tokens bigint").filter("tokens > 0"), "token-files")
    tasks = lengths.agg(F.sum(F.ceil(F.col("tokens") / block_tokens))).first()[0] or 1
    blocks = (lengths.select("file", "tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(tokens - 1) div {block_tokens}"))).alias("block"))
              .repartition(tasks, "file", "block"))     # tiny rows, large reads: a task a block

    def scanned(batches):
        for batch in batches:
            for uri, tokens, block in zip(*(batch.column(c).to_pylist() for c in ("file", "tokens", "block"))):
                begin = block * block_tokens
                with _open(uri) as f:
                    data = np.frombuffer(f.read_at(min(block_tokens, tokens - begin) * width, begin * width), dtype)
                ends = np.flatnonzero(data == eod) + begin
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri]), pa.array([block]), pa.array([tokens], pa.int64()), pa.array([len(ends)], pa.int64()),
                     pa.array([int(ends[-1]) if len(ends) else None], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    ["file", "block", "tokens", "n", "last", "ends"])

    found = staged(blocks.mapInArrow(
        scanned, "file string, block bigint, tokens bigint, n bigint, last bigint, ends array<bigint>"), "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("doc0"),
                           F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)).alias("prev"))
    stitched = found.join(carried, ["file", "block"])
    # each separator ends a document that starts after the one before it
    each = stitched.select("file", "doc0", "prev", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("prev")).otherwise(F.get("ends", F.col("i") - 1)) + 1
    closed = each.select("file", (F.col("doc0") + F.col("i")).alias("doc"), start.alias("start"),
                         (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("terminated"))
    tails = (found.groupBy("file").agg(F.max("tokens").alias("tokens"), F.sum("n").alias("doc"),
                                       F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
             .filter("last < tokens - 1")
             .select("file", "doc", (F.col("last") + 1).alias("start"), (F.col("tokens") - F.col("last") - 1).alias("n_tokens"),
                     F.lit(False).alias("terminated")))
    return closed.union(tails)


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS, eod: int = EOD,
                 dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(key, n_tokens, start, terminated) of every row of ``docs``, through token files."""
    manifest = write_token_files(docs, key, text, ranks, eod, dtype)
    return manifest.join(scan_separators(manifest, eod, dtype, block_tokens), ["file", "doc"]).select(
        key, "n_tokens", "start", "terminated")

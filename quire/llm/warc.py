"""Monolithic gzip normaliser for WARC files.

A WARC file that was compressed as one gzip stream can only be read from its start.  The
normaliser inflates such a file once, as a stream, writes every record as a gzip member of
its own, and writes a sidecar of fixed-width lines (offset, length, type).  After that any
range of records can be read by seeking: a big archive is dealt over many tasks.

``write_monolithic`` makes such files from a table of pages.  ``revisits`` finds equal payloads by SHA-1
(counted and reduced before the shuffle) and tells the normaliser which records to turn into
``revisit`` records that keep the HTTP header and drop the payload.

Files go to the shared checkpoint folder (or a given URI) through pyarrow.fs.  Every task attempt
writes files of new names, and only names returned by committed attempts are read, so
a lost executor leaves at most unused files.  Files are cut at ``file_bytes`` of records, memory
is one block of a stream.

Null payloads are empty.  A null id gives a record without page id; it comes last among equal
payloads.  Repeated rows are equal payloads like others: the first is the response.  Control
characters in URLs are percent-encoded; a header, URL included, may have 64 MB.  Columns but for the named
ones are ignored.  Archives of other writers are read too: a record that is not HTTP (``warcinfo``, ``metadata``, ...) has its
whole block as payload, an HTTP record what follows its HTTP header, as stored (a chunked body stays chunked).
A missing payload digest is computed; a given one is checked where it must hold: SHA-1 of a body that was not sent chunked.
Truncated files and records raise.  An empty table
gives no files; a file without records gives an archive without members.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import slices, staged
from quire.session import work_path

CHUNK = 1 << 20
FILE_BYTES = 64 << 20
#: longest record header that is read (a URL of many megabytes is in it)
HEADER_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
_LINE = 54          # two numbers of 20 digits, a type of 11, two spaces and a line feed
_ID = re.compile(rb"<urn:page:(-?\d+)>")


def _store(uri: str):
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Inflated:
    """Bytes of a gzip file of one or more members, inflated as they are asked for."""

    def __init__(self, read):
        self.read_more, self.plain, self.at = read, b"", 0
        self.inflate, self.rest, self.ended = zlib.decompressobj(31), b"", False

    def _fill(self) -> bool:
        while not self.ended:
            data = self.rest or self.read_more(CHUNK)
            if not data:
                self.ended = True
                if not self.inflate.eof and self.started:
                    raise ValueError("the gzip stream ends early")
                return False
            self.started = True
            plain = self.inflate.decompress(data, CHUNK)
            self.rest = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
                self.inflate, self.started = zlib.decompressobj(31), False
            if plain:
                self.plain, self.at = self.plain[self.at:] + plain, 0
                return True
        return False

    started = False

    def until(self, mark: bytes, limit: int = HEADER_BYTES) -> bytes:
        """Bytes up to and with ``mark``; b"" at the end of the file."""
        while (end := self.plain.find(mark, self.at)) < 0:
            if len(self.plain) - self.at > limit:
                raise ValueError("a record header is too long")
            if not self._fill():
                if self.plain[self.at:].strip():
                    raise ValueError("the last record is cut off")
                return b""
        out, self.at = self.plain[self.at:end + len(mark)], end + len(mark)
        return out

    def parts(self, size: int):
        """The next ``size`` bytes in pieces."""
        while size:
            if self.at == len(self.plain) and not self._fill():
                raise ValueError("a record is cut off")
            piece = self.plain[self.at:self.at + min(size, CHUNK)]
            self.at += len(piece)
            size -= len(piece)
            yield piece


def headers(block: bytes) -> dict[bytes, bytes]:
    """Header fields by lower-case name."""
    lines = (line.partition(b":") for line in block.split(b"\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def records(stream: Inflated):
    """(header block, fields, stream) of each record; the caller must read its body."""
    while block := stream.until(b"\r\n\r\n"):
        block = block.lstrip(b"\r\n")
        if not block.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        yield block, headers(block)
        if b"".join(stream.parts(4)) != b"\r\n\r\n":
            raise ValueError("a record is not closed")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def response_record(key: int | None, url: str | None, payload: bytes, sha1: str, date: str) -> list[bytes]:
    """A response record in pieces."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = f"<urn:page:{key}>" if key is not None else f"<urn:uuid:{uuid.uuid4()}>"
    target = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode()) if url is not None else b""
    head = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: " + name.encode() + b"\r\nWARC-Date: " + date.encode() + b"\r\n"
            + (b"WARC-Target-URI: " + target + b"\r\n" if target else b"")
            + b"WARC-Payload-Digest: sha1:" + sha1.encode() + b"\r\nContent-Type: application/http; msgtype=response\r\n"
            + b"Content-Length: %d\r\n\r\n" % (len(http) + len(payload)))
    return [head, http, payload, b"\r\n\r\n"]


def write_monolithic(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                     folder: str | None = None, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Archives of one gzip stream each; (file, seq, key, payload_bytes, payload_digest) of every record."""
    root = folder or work_path(pages.sparkSession, "warc-mono")
    rows = pages.select(F.col(key).cast("bigint").alias("id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))

    def written(batches):
        store, path = _store(root)
        store.create_dir(path, recursive=True)
        out = name = squeeze = None
        seq = size = 0
        for part, texts in slices(batches, "payload"):
            made = [[] for _ in range(4)]
            for key_, url_, body in zip(part.column("id").to_pylist(), part.column("url").to_pylist(), texts):
                if out is None:
                    name, squeeze, seq, size = f"{uuid.uuid4().hex}.warc.gz", zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                sha1 = digest(body)
                for piece in response_record(key_, url_, body, sha1, date):
                    out.write(squeeze.compress(piece))
                    size += len(piece)
                for x, v in zip(made, (f"{root}/{name}", seq, len(body), sha1)):
                    x.append(v)
                seq += 1
                if size >= file_bytes:
                    out.write(squeeze.flush())
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[0], pa.string()), pa.array(made[1], pa.int64()), part.column("id"),
                 pa.array(made[2], pa.int64()), pa.array(made[3], pa.string())], ["file", "seq", "id", "payload_bytes", "payload_digest"])
        if out is not None:
            out.write(squeeze.flush())
            out.close()

    return staged(rows.mapInArrow(written, "file string, seq bigint, id bigint, payload_bytes bigint, payload_digest string"),
                  "warc-manifest").withColumnRenamed("id", key)


def revisits(manifest: DataFrame, key: str = "page_id", min_bytes: int = 0) -> DataFrame:
    """(file, seq, refers_to): records whose payload of at least ``min_bytes`` bytes an earlier id has."""
    rows = manifest.filter(F.col("payload_bytes") >= min_bytes).select(
        "payload_digest", "payload_bytes", F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("id"), "file", "seq").alias("at"))
    first = rows.groupBy("payload_digest", "payload_bytes").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return (rows.join(first, ["payload_digest", "payload_bytes"]).filter("at != first")
            .select("at.file", "at.seq", F.col("first.id").alias("refers_to")))


def normalise(files: DataFrame, plan: DataFrame | None = None, folder: str | None = None, level: int = 6) -> DataFrame:
    """(file, archive, sidecar, n): every file of ``files(file)`` with one member a record.

    ``plan(file, seq, refers_to)`` names records to write as revisits."""
    root = folder or work_path(files.sparkSession, "warc")
    names = files.select("file").filter("file is not null").distinct()
    if plan is None:
        plan = names.select("file", F.lit(0).cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("refers_to")).limit(0)
    # a file has a bounded number of records, so its list is bounded too
    asked = plan.groupBy("file").agg(F.collect_list(F.struct("seq", "refers_to")).alias("again"))

    def rewritten(batches):
        out_store, path = _store(root)
        out_store.create_dir(path, recursive=True)
        for batch in batches:
            for uri, again in zip(batch.column("file").to_pylist(), batch.column("again").to_pylist()):
                refers = {x["seq"]: x["refers_to"] for x in again or []}
                store, place = _store(uri)
                name, offset, n = uuid.uuid4().hex, 0, 0
                with store.open_input_stream(place, compression=None) as raw, \
                        out_store.open_output_stream(f"{path}/{name}.warc.gz", compression=None) as out, \
                        out_store.open_output_stream(f"{path}/{name}.idx", compression=None) as index:
                    stream = Inflated(raw.read)
                    for seq, (head, fields) in enumerate(records(stream)):
                        body, kind = stream.parts(int(fields[b"content-length"])), fields[b"warc-type"]
                        if seq in refers:
                            # a revisit keeps the HTTP header of its record
                            whole = b""
                            for piece in body:
                                if b"\r\n\r\n" not in whole:
                                    whole += piece
                            http = whole.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
                            lines = [x for x in head.split(b"\r\n") if x and x.partition(b":")[0].lower() not in (b"warc-type", b"content-length")]
                            # a response without id has no name to refer to
                            target = [b"WARC-Refers-To: <urn:page:%d>" % refers[seq]] if refers[seq] is not None else []
                            head = b"\r\n".join([lines[0], b"WARC-Type: revisit", *lines[1:], *target,
                                                 b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                                                 b"Content-Length: %d" % len(http), b"", b""])
                            body, kind = [http], b"revisit"
                        squeeze, size = zlib.compressobj(level, zlib.DEFLATED, 31), 0
                        for piece in (head, *body, b"\r\n\r\n") if isinstance(body, list) else _chain(head, body):
                            data = squeeze.compress(piece)
                            size += out.write(data)
                        size += out.write(squeeze.flush())
                        index.write(b"%020d %020d %-11s\n" % (offset, size, kind[:11]))
                        offset, n = offset + size, n + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri]), pa.array([f"{root}/{name}.warc.gz"]), pa.array([f"{root}/{name}.idx"]), pa.array([n], pa.int64())],
                    ["file", "archive", "sidecar", "n"])

    # the rows are tiny and the files are not: as many tasks as files
    tasks = max(1, names.count())
    return staged(names.join(asked, "file", "left").repartition(tasks, "file").mapInArrow(
        rewritten, "file string, archive string, sidecar string, n bigint"), "warc-archives")


def _chain(head, body):
    yield head
    yield from body
    yield b"\r\n\r\n"


def read_records(archives: DataFrame, records_a_task: int = 2048, with_payload: bool = False) -> DataFrame:
    """Records of ``archives(archive, sidecar, n)``, found through the sidecars and read by range.

    (archive, seq, page_id, record_type, refers_to, payload_bytes, payload_digest[, payload]).
    The digest of a payload that is there is computed and must equal the header's; a revisit's size is
    that of its HTTP header, null if that names none, and its digest the header's."""
    tasks = archives.agg(F.sum(F.ceil(F.col("n") / records_a_task))).first()[0] or 1
    ranges = (archives.filter("n > 0")
              .select("archive", "sidecar", "n", F.explode(F.expr(f"sequence(0l, n - 1, {records_a_task}l)")).alias("seq0"))
              .repartition(tasks, "archive", "seq0"))

    def read(batches):
        for batch in batches:
            for archive, sidecar, n, seq0 in zip(*(c.to_pylist() for c in batch.columns)):
                count = min(records_a_task, n - seq0)
                store, place = _store(sidecar)
                with store.open_input_file(place) as f:
                    lines = f.read_at(count * _LINE, seq0 * _LINE).decode().splitlines()
                store, place = _store(archive)
                with store.open_input_file(place) as f:
                    for at in range(0, count, 64):
                        out = [[] for _ in range(7)]
                        for seq, line in enumerate(lines[at:at + 64], seq0 + at):
                            f.seek(int(line[:20]))
                            stream = Inflated(_upto(f, int(line[21:41])))
                            (head, fields), = [(h, d) for h, d in _one(stream)]
                            kind = fields.get(b"warc-type", b"").decode()
                            http, body = _payload(stream, fields)
                            size, found, kept = 0, hashlib.sha1(), []
                            for piece in body:
                                size += len(piece)
                                found.update(piece)
                                if with_payload:
                                    kept.append(piece)
                            method, _, given = fields.get(b"warc-payload-digest", b"").partition(b":")
                            sha1 = base64.b32encode(found.digest()).decode()
                            if kind == "revisit":
                                size = http.get(b"content-length", b"")
                                size, sha1 = int(size) if size.isdigit() else None, given.decode() or None
                            elif method.lower() == b"sha1" and b"transfer-encoding" not in http and given.decode() != sha1:
                                raise ValueError(f"payload of record {seq} of {archive} is damaged")
                            ids = [m and int(m[1]) for m in (_ID.fullmatch(fields.get(k, b"")) for k in (b"warc-record-id", b"warc-refers-to"))]
                            for x, v in zip(out, (seq, ids[0], kind, ids[1], size, sha1, b"".join(kept) if kind != "revisit" else None)):
                                x.append(v)
                        arrays = [pa.array([archive] * len(out[0])), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                  pa.array(out[2], pa.string()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.string())]
                        names = ["archive", "seq", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
                        if with_payload:
                            arrays, names = [*arrays, pa.array(out[6], pa.binary())], [*names, "payload"]
                        yield pa.RecordBatch.from_arrays(arrays, names)

    schema = ("archive string, seq bigint, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, "
              "payload_digest string" + (", payload binary" if with_payload else ""))
    return ranges.mapInArrow(read, schema)


def _one(stream: Inflated):
    block = stream.until(b"\r\n\r\n")
    if not block.startswith(b"WARC/"):
        raise ValueError("the sidecar does not point at a record")
    yield block, headers(block)


def _payload(stream: Inflated, fields: dict[bytes, bytes]):
    """(HTTP header fields, pieces of the payload) of a record whose WARC header was read.

    A block that should be HTTP but holds no end of a header is all payload."""
    body = stream.parts(int(fields.get(b"content-length", b"0")))
    if not fields.get(b"content-type", b"").lower().startswith(b"application/http"):
        return {}, body
    begun = b""
    for piece in body:
        begun += piece
        if b"\r\n\r\n" in begun or len(begun) > HEADER_BYTES:
            break
    head, mark, rest = begun.partition(b"\r\n\r\n")
    return (headers(head), _rest(rest, body)) if mark else ({}, _rest(begun, body))


def _rest(first: bytes, pieces):
    if first:
        yield first
    yield from pieces


def _upto(f, size: int):
    left = size

    def read(n: int) -> bytes:
        nonlocal left
        data = f.read(min(n, left))
        left -= len(data)
        return data

    return read


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0,
                  file_bytes: int = FILE_BYTES, records_a_task: int = 2048) -> DataFrame:
    """Write pages to monolithic archives, normalise them with revisits, and read the result back."""
    manifest = write_monolithic(pages, key, url, payload, file_bytes=file_bytes)
    archives = normalise(manifest, revisits(manifest, key, min_bytes))
    return read_records(archives, records_a_task).withColumnRenamed("page_id", key)

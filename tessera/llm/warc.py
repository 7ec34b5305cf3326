"""WARC writer and splittable reader (operator 3).

Each record is a gzip member of its own.  The writer finds equal payloads by
digest (pre-aggregated; texts are not shuffled while the table of revisits is
small enough to broadcast) and writes one archive per task to a shared folder: under a
temporary name first, so a task that is lost and runs again leaves one whole file.

The reader gives each task byte ranges.  A task looks for the gzip magic from the
start of its range, takes a place as a member only if it inflates to a WARC header
block, and owns the records whose first byte lies in its range; a record may end
in a later range.  After a record the next one is expected where it ended;
whatever else stands there is scanned over.

Foreign archives are read too: header names in any case, folded lines, ids of any
form (``record_id``; ``page_id`` only for those written here), records without a digest.  Records of
other types (warcinfo, request, metadata) are left out unless asked for.  A member that starts as a WARC record but cannot be
read to its end (cut off, broken, without a valid length) is a record of type ``malformed``, left out
likewise; reading goes on behind its first byte.

Cases: null html is an empty payload, null url is left out and read back as
null, a null id is written as no id and read back as null.  Rows that repeat the
smallest id of a payload are all responses.  An empty table writes archives
without records.  Line breaks in urls are percent-encoded.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, materialize, new_path, small

MIN_REVISIT = 100
LEVEL = 4
SPLIT_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
_MAGIC, _READ, _PIECE = b"\x1f\x8b\x08", 1 << 20, 1 << 16
_URN = "urn:tessera:page:"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's view of a path or URI."""
    if "://" in path or path.startswith("file:"):
        return (pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str, date: str = DATE, level: int = LEVEL) -> bytes:
    """One gzip member: a response, or a revisit of refers_to (its block is the HTTP head only)."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    ident = "" if page_id is None else str(page_id)
    head = [f"WARC/1.1\r\nWARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_URN}{ident}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + c.flush()


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that starts with a blank goes on with the one before."""
    fields, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields


def parse(raw: bytes, payload: bool) -> dict:
    """The fields of one inflated record; record_type is ``malformed`` if its length is missing or its block cut off."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head.partition(b"\r\n")[2])
    name = lambda f: fields[f].strip("<>") if fields.get(f) else None
    number = lambda x: int(x.removeprefix(_URN)) if x and x.startswith(_URN) and x.removeprefix(_URN).lstrip("-").isdigit() else None
    ident, refers, kind = name("warc-record-id"), name("warc-refers-to"), fields.get("warc-type", "").lower()
    out = {"page_id": number(ident), "record_id": None if ident == _URN else ident, "url": name("warc-target-uri"), "record_type": kind, "refers_to": number(refers), "refers_to_id": refers,
           "payload_bytes": None, "payload_digest": None, "payload": None}
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()) or len(rest) < int(size) or not kind:
        return out | {"record_type": "malformed"}
    block = rest[: int(size)]
    http, _, body = block.partition(b"\r\n\r\n") if fields.get("content-type", "").lower().startswith("application/http") else (b"", b"", block)
    if kind == "revisit":
        length = _fields(http).get("content-length", "")
        digest = fields.get("warc-payload-digest")
        return out | {"payload_bytes": int(length) if length.isascii() and length.isdigit() else None, "payload_digest": digest.removeprefix("sha256:") if digest else None}
    return out | {"payload_bytes": len(body), "payload_digest": hashlib.sha256(body).hexdigest(), "payload": body if payload else None}


class _Archive:
    """Random access to one archive by a sliding buffer."""

    def __init__(self, path: str):
        store, name = filesystem(path)
        self.file = store.open_input_file(name)
        self.size, self.base, self.buf = self.file.size(), 0, b""

    def at(self, p: int, n: int) -> memoryview:
        """Up to n bytes from p."""
        if not self.base <= p <= p + min(n, self.size - p) <= self.base + len(self.buf):
            self.file.seek(p)
            self.base, self.buf = p, self.file.read(max(n, _READ))
        return memoryview(self.buf)[p - self.base : p - self.base + n]

    def member(self, p: int) -> tuple[bytes, int] | None:
        """(inflated record, offset after it) if a WARC record starts at p; (what there is of it, p + 1) if it can't be read to its end."""
        if bytes(self.at(p, 3)) != _MAGIC:
            return None
        inflate, out, q = zlib.decompressobj(31), [], p
        try:
            while not inflate.eof:
                piece = self.at(q, _PIECE)
                if not piece:
                    break
                q += len(piece)
                out.append(inflate.decompress(piece))
                if len(out) == 1 and out[0] and not out[0].startswith(b"WARC/"[: len(out[0])]):
                    return None
        except zlib.error:
            pass
        raw = b"".join(out)
        if not raw.startswith(b"WARC/"):
            return None
        return (raw, q - len(inflate.unused_data)) if inflate.eof and b"\r\n\r\n" in raw else (raw[:0], p + 1)

    def find(self, p: int, end: int) -> int:
        """The first place of the magic in [p, end), or end."""
        while p < end:
            piece = bytes(self.at(p, _READ))
            i = piece.find(_MAGIC)
            if i >= 0:
                return min(p + i, end)
            if len(piece) < 3 or p + len(piece) >= self.size:
                return end
            p += len(piece) - 2
        return end


def records_in(path: str, start: int, end: int) -> Iterator[bytes]:
    """The inflated records of an archive whose first byte lies in [start, end); empty for one that can't be read to its end."""
    archive, p = _Archive(path), start
    while (p := archive.find(p, min(end, archive.size))) < min(end, archive.size):
        found = archive.member(p)
        if found:
            raw, p = found
            yield raw
        else:
            p += 1


def mark_revisits(pages: DataFrame, *, id_col: str, html_col: str, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """pages with digest and refers_to (the smallest id with the same payload, where that is another row's)."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    marked = pages.withColumns({"tessera_digest": F.sha2(html.cast("binary"), 256)})
    keys = materialize(marked.where(F.octet_length(html) >= min_bytes).select("tessera_digest", F.col(id_col).alias("tessera_id")), "warc-keys")
    first = keys.groupBy("tessera_digest").agg(F.min("tessera_id").alias("tessera_first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = marked.join(small(materialize(first, "warc-first")), "tessera_digest", "left")
    return marked.withColumn("tessera_refers", F.when(~F.col("tessera_first").eqNullSafe(F.col(id_col)), F.col("tessera_first"))).drop("tessera_first")


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = MIN_REVISIT, level: int = LEVEL) -> DataFrame:
    """Writes pages as archives below path; returns (path, bytes, records) of the archives, written and counted."""
    bound_batches(pages.sparkSession)
    rows = mark_revisits(pages, id_col=id_col, html_col=html_col, min_bytes=min_bytes).select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"),
        F.col("tessera_digest").alias("digest"), F.col("tessera_refers").cast("long").alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, top = filesystem(path)
        store.create_dir(top, recursive=True)
        name = f"{top}/part-{task.partitionId():06d}.warc.gz"
        half, size, n = f"{name}.{task.taskAttemptId()}.tmp", 0, 0
        with store.open_output_stream(half, compression=None) as out:
            for batch in batches:
                html = batch.column(2).cast(pa.large_binary())
                for i, (ident, url, digest, refers) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4)), strict=True)):
                    member = record(ident, url, html[i].as_py() or b"", refers, digest, level=level)
                    out.write(member)
                    size, n = size + len(member), n + 1
        try:
            store.move(half, name)
        except OSError:  # where a move doesn't replace what a lost run of this task has left
            store.delete_file(name)
            store.move(half, name)
        uri = f"file://{name}" if isinstance(store, pafs.LocalFileSystem) else f"{path.rstrip('/')}/part-{task.partitionId():06d}.warc.gz"
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])

    return materialize(rows.mapInArrow(write, "path string, bytes bigint, records bigint"), "warc-files")


_RECORD = {"page_id": "bigint", "record_id": "string", "url": "string", "record_type": "string", "refers_to": "bigint", "refers_to_id": "string",
           "payload_bytes": "bigint", "payload_digest": "string", "payload": "binary"}


def read_warc(archives: DataFrame, *, split_bytes: int = SPLIT_BYTES, payload: bool = True, types: tuple[str, ...] | None = ("response", "revisit")) -> DataFrame:
    """Records of archives(path, bytes): page_id, record_id, url, record_type, refers_to, refers_to_id, payload_bytes, payload_digest, payload.

    types: the record types to read, None for all, ``malformed`` among them.  payload is null for revisits, and everywhere with payload=False.
    """
    ranges = archives.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.withColumn("end", F.col("start") + split_bytes)
    ranges = ranges.repartition(max(ranges.sparkSession.sparkContext.defaultParallelism, int(ranges.count())))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = {c: "Int64" for c, kind in _RECORD.items() if kind == "bigint"}
        for batch in batches:
            for path, start, end in batch.itertuples(index=False):
                held, size = [], 0
                for raw in records_in(path, start, end):
                    found = parse(raw, payload)
                    if types is None or found["record_type"] in types:
                        held.append(found)
                        size += len(raw) if payload else 300
                    if size > 8 << 20:
                        yield pd.DataFrame(held, columns=[*_RECORD]).astype(whole)
                        held, size = [], 0
                if held:
                    yield pd.DataFrame(held, columns=[*_RECORD]).astype(whole)

    return ranges.mapInPandas(read, ", ".join(f"{c} {kind}" for c, kind in _RECORD.items()))


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of archives that already lie below path; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.warc.gz").load(path).select("path", F.col("length").alias("bytes"))


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Writes pages to a new folder and reads every record back, without payloads."""
    return read_warc(write_warc(pages, new_path(pages.sparkSession, "warc"), **columns), payload=False)

"""WARC archives compressed record by record with a shared Zstandard dictionary.

An archive (``.warc.zst``) starts with a skippable frame that holds the
dictionary; each record follows as a Zstandard frame of its own, so a record
can be read without its predecessors. The dictionary is trained on a bounded
sample of the records of all archives: about ``SAMPLE_RECORDS`` (twice as many at
most) by the hashes of their places in the table, and of each the ``SAMPLE_BYTES``
from a place that the same hash names. It serves compression alone; records are
stored whole.

Payloads met before are ``revisit`` records: of the pages whose payloads are
equal (SHA-256) and at least ``min_bytes`` long, that with the smallest id is the
``response``, the others refer to it. Only ids and digests are grouped; the pages
themselves move once, by digest, and a digest that very many pages share is
salted over many tasks.

Writers run in Spark tasks and write straight into the target folder, by any
file system pyarrow knows. A file's name holds the task attempt; the manifest
is a table that Spark commits, so an attempt that was lost or repeated leaves
at most a file that no manifest names. Memory: the sample on the driver, one record in a task.

Defined cases: a null payload is an empty one; a null id is smaller than none
(it is the response only where all ids are null) and comes back as null; rows
with the same id and payload are all responses or all revisits of that id; an
empty table gives no archive; control characters in URLs are percent-encoded; a
payload of any length is one record; other columns, whatever their names, are
not written.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import SkewGuard, salted_left_join
from .common import shuffle_partitions, slices, stored

#: Fixed values of the formats: the skippable frame that carries a dictionary,
#: the WARC version and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_RECORDS = 1024
SAMPLE_BYTES = 8 << 10
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
_RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri and not uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{payload_digest}')}>"


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [VERSION, f"WARC-Type: {kind}".encode(), *(f"{k}: {v}".encode("utf-8", "replace") for k, v in fields),
            f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                date: str) -> bytes:
    own = digest(payload)
    fields = [("WARC-Record-ID", _record_id(page_id, own)), ("WARC-Date", date),
              ("WARC-Target-URI", _clean(url) if url else f"urn:page:{page_id}"),
              ("WARC-Payload-Digest", f"sha1:{own}"), ("Content-Type", "application/http;msgtype=response"),
              ("Page-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        return record("response", fields, block + payload)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to, own)),
               ("Page-Refers-To", str(refers_to))]
    return record("revisit", fields, block)


def as_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    """A stored dictionary again; one that was not trained starts without the magic number."""
    return zstandard.ZstdCompressionDict(data)


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; with too little to train on, the records' own bytes."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 8)), samples, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:] or b"WARC/1.1",
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(out, records: Iterator[bytes], known: zstandard.ZstdCompressionDict,
                  limit: int = ARCHIVE_BYTES) -> tuple[int, int]:
    """One archive from the iterator, up to ``limit`` bytes; (bytes, records) written."""
    data = known.as_bytes()
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
    total, n = 0, 0
    for r in records:
        if not n:
            out.write(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
            total = 8 + len(data)
        frame = compressor.compress(r)
        out.write(frame)
        total += len(frame)
        n += 1
        if total >= limit:
            break
    return total, n


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, one record in memory."""
    head = source.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with a dictionary frame")
    known = zstandard.ZstdCompressionDict(source.read(size))
    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=known).stream_reader(
        source, read_across_frames=True), 1 << 16)
    while line := plain.readline():
        if line.rstrip(b"\r\n") != VERSION:
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := plain.readline().rstrip(b"\r\n")):
            key, _, value = line.decode().partition(": ")
            fields[key] = value
        block = plain.read(int(fields["Content-Length"]))
        if len(block) != int(fields["Content-Length"]) or plain.read(4) != b"\r\n\r\n":
            raise ValueError(f"cut off record {fields.get('WARC-Record-ID')}")
        yield fields, block


def _write_task(folder: str, date: str, dictionary: bytes):
    def task(batches):
        context = TaskContext.get()
        known = as_dictionary(dictionary)
        store, base = file_system(folder)

        def records():
            for run in slices(batches, 2):
                for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in run.columns)):
                    yield page_record(page_id, url, payload, refers_to, revisit, date)
        source, rows = records(), []
        while True:
            path = (f"{base}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(rows):04d}.warc.zst")
            first = next(source, None)
            if first is None:
                break

            def from_first(first=first):
                yield first
                yield from source
            with store.open_output_stream(path) as out:
                size, n = write_archive(out, from_first(), known)
            rows.append((f"{folder.rstrip('/')}/{path.rpartition('/')[2]}", size, n))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["path", "bytes", "records"])
    return task


def _read_task(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, name = file_system(path)
            rows = []
            with store.open_input_stream(name) as source:
                for fields, block in read_archive(source):
                    own = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and digest(block.partition(b"\r\n\r\n")[2]) != own:
                        raise ValueError(f"payload differs from its digest: {fields['WARC-Record-ID']} in {path}")
                    page, first = fields.get("Page-ID"), fields.get("Page-Refers-To")
                    rows.append((None if page is None else int(page), int(fields["Page-Payload-Length"]), own,
                                 fields["WARC-Type"], None if first is None else int(first)))
                    if len(rows) >= 10_000:
                        yield _rows(rows)
                        rows = []
            if rows:
                yield _rows(rows)


def _rows(rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          min_bytes: int = 0, date: datetime | None = None, guard: SkewGuard = SkewGuard()) -> DataFrame:
    """Write the archives; the manifest (path, bytes, records) is stored.

    Payloads shorter than ``min_bytes`` are always responses.
    """
    when = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.when(F.octet_length(payload) >= min_bytes, F.sha2(payload, 256)).alias("sha"))
    first = (rows.filter(F.col("sha").isNotNull()).groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 and first is not null").select("sha", "first"))
    again = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    # pages of no group are dealt by their digests too, short ones by a hash of their own
    key = F.coalesce("sha", F.concat(F.lit("short "), F.xxhash64("id", "url", "payload").cast("string")))
    ready = (salted_left_join(rows.withColumn("sha", key), first, "sha", guard)
             .select("id", "url", "payload", again.alias("revisit"), F.when(again, F.col("first")).alias("first")))
    dictionary = train(sample_records(rows, when)).as_bytes()
    return stored(ready.mapInArrow(_write_task(folder, when, dictionary), "path string, bytes bigint, records bigint"),
                  "warc-manifest")


def sample_records(rows: DataFrame, date: str) -> list[bytes]:
    """Records of a bounded sample of pages, for the dictionary."""
    most = min(2 ** 63 - 1, 2 ** 63 * SAMPLE_RECORDS // max(1, rows.count()))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(11), F.monotonically_increasing_id()), 1)
    begin = F.pmod(F.shiftrightunsigned(F.col("place"), 8), F.greatest(F.octet_length("payload") - SAMPLE_BYTES, F.lit(1)))
    some = (rows.select("id", "url", "payload", place.alias("place")).filter(F.col("place") <= most)
            .select("id", "url", F.substring("payload", (begin + 1).cast("int"), F.lit(SAMPLE_BYTES)).alias("part"))
            .limit(2 * SAMPLE_RECORDS).collect())            # about SAMPLE_RECORDS
    return [page_record(r.id, r.url and r.url[:SAMPLE_BYTES], bytes(r.part), None, False, date) for r in some]


def read(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    ``manifest`` has a column ``path``. Payloads are held against their digests.
    """
    paths = manifest.select("path").repartition(shuffle_partitions(manifest.sparkSession), "path")
    return paths.mapInArrow(_read_task, _RECORDS)

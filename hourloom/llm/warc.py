"""WARC archives: a writer with revisit records and a splittable reader.

Archives hold one gzip member per record. The writer stores a payload once: of records with equal
payloads of at least ``least_bytes`` bytes the one with the largest id is the response and the rest
revisit it. The reader cuts archives into byte ranges; a task scans its range for the gzip magic,
takes a candidate only if a WARC header decodes from it, and owns the records that start inside,
reading past the end of the range for the last one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import release, shared_path, staged

MAGIC = b"\x1f\x8b\x08"
#: Bytes that a reading task scans.
RANGE_BYTES = 8 << 20
#: Bytes asked for at a time past the end of a range.
TAIL_BYTES = 1 << 20
#: A header must end within so many bytes of its record.
HEADER_BYTES = 16 << 10
LEVEL = 4


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI or plain path, and the path in it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def record(page_id: int | None, url: str, payload: bytes | None, digest: str, size: int, refers_to: int | None) -> bytes:
    """One gzip member: the WARC header and, for a response, the payload."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(body)}")
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    plain = ("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + body + b"\r\n\r\n"
    return packer.compress(plain) + packer.flush()


def parse_header(plain: bytes) -> dict[str, str] | None:
    """The fields of a record that starts here; None if it is not a whole WARC header."""
    if not plain.startswith(b"WARC/1."):
        return None
    end = plain.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in plain[:end].split(b"\r\n")[1:]:
        name, sep, value = line.partition(b": ")
        if not sep:
            return None
        fields[name.decode("latin-1").lower()] = value.decode("utf-8", "replace")
    return fields if "warc-type" in fields and fields.get("content-length", "").isdigit() else None


def records_in(read, start: int, end: int, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and body of each record whose member starts in [start, end) of a file of ``size``
    bytes; ``read(at, n)`` gives bytes of it."""
    if start >= end:
        return
    data = read(start, min(size, end + len(MAGIC) - 1) - start)
    at = 0
    while True:
        at = data.find(MAGIC, at)
        if at < 0 or start + at >= end:
            return
        # validate the candidate by decoding the first bytes of its header
        unpack = zlib.decompressobj(31)
        try:
            plain = unpack.decompress(data[at:at + HEADER_BYTES], HEADER_BYTES)
            while b"\r\n\r\n" not in plain and len(plain) < HEADER_BYTES and start + len(data) < size \
                    and len(data) - at < HEADER_BYTES:
                data += read(start + len(data), min(TAIL_BYTES, size - start - len(data)))
                unpack = zlib.decompressobj(31)
                plain = unpack.decompress(data[at:at + HEADER_BYTES], HEADER_BYTES)
        except zlib.error:
            at += 1
            continue
        if not plain.startswith(b"WARC/1."):
            at += 1
            continue
        unpack = zlib.decompressobj(31)
        parts = []
        used = at
        try:
            while not unpack.eof:
                if used >= len(data):
                    if start + len(data) >= size:
                        break
                    data += read(start + len(data), min(TAIL_BYTES, size - start - len(data)))
                piece = data[used:used + TAIL_BYTES]
                parts.append(unpack.decompress(piece))
                used += len(piece)
        except zlib.error:
            at += 1
            continue
        whole = b"".join(parts)
        fields = parse_header(whole)
        if not unpack.eof or fields is None:
            at += 1
            continue
        body = whole.find(b"\r\n\r\n") + 4
        yield fields, whole[body:body + int(fields["content-length"])]
        at = used - len(unpack.unused_data)


def revisits(pages: DataFrame, id_col: str, payload: Column, least_bytes: int) -> DataFrame:
    """(id, digest, size, refers_to) of the records that revisit another; thin rows only."""
    thin = staged(pages.select(F.col(id_col).cast("long").alias("id"), F.sha1(payload).alias("digest"),
                               F.octet_length(payload).cast("long").alias("size"))
                  .where((F.col("size") >= least_bytes) & F.col("id").isNotNull()), "digests")
    shared = thin.groupBy("digest", "size").agg(F.max("id").alias("last"), F.min("id").alias("least")).where(
        "last > least")
    return (thin.join(shared, ["digest", "size"]).where("id < last")
            .select("id", "digest", "size", F.col("last").alias("refers_to")).distinct())


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write one record per row of ``pages`` under ``path``; returns the staged list of archives
    (path, bytes, records).

    A task writes its rows into one archive of its own name, never overwritten by another attempt;
    the list is committed by Spark, so it names exactly one attempt's archive for each part. Rows
    with a null id are written and never take part in revisits; rows that repeat an id are all
    written, each judged by its own payload, and the ones with the largest id of their payload are all
    responses. A null payload is
    empty, a null URL too.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    found = revisits(pages, id_col, payload, least_bytes)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"),
                        F.octet_length(payload).cast("long").alias("size"))
    marked = rows.join(found, ["id", "digest", "size"], "left").select(
        "id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest", "size",
        "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, folder = filesystem(path)
        store.create_dir(folder, recursive=True)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        n = size = 0
        out = None
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if out is None:
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                url = " ".join(r[1].split())  # a header field is one line
                member = record(r[0], url, r[2], r[3], r[4], r[5])
                out.write(member)
                n += 1
                size += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{path}/{name}"]), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
                ["path", "bytes", "records"])

    listed = staged(marked.mapInArrow(write, "path string, bytes long, records long"), "archives")
    release(spark)
    return listed


def read_archives(listed: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = False) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest[, payload]) of every
    record of the archives in ``listed`` (path, bytes).

    ``payload_bytes`` and the digest (lower-case hex SHA-1) are of the full payload: measured on
    what a response holds, and for a revisit as its header says. Each byte range is a row, so the
    ranges spread over the cluster and a lost task only reads its ranges again.
    """
    ranges = listed.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
        .alias("start"))
    tasks = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = ranges.repartition(tasks, "path", "start")
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payloads
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * payloads

    def number(urn: str | None) -> int | None:
        text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                store, where = filesystem(path)
                rows, held = [], 0
                with store.open_input_file(where) as f:
                    for head, body in records_in(lambda at, n: f.read_at(n, at), start, min(size, start + range_bytes), size):
                        kind = head["warc-type"]
                        full = kind == "response"
                        rows.append((number(head.get("warc-record-id")), head.get("warc-target-uri", ""), kind,
                                     number(head.get("warc-refers-to")),
                                     len(body) if full else int(head.get("x-payload-length", "0")),
                                     hashlib.sha1(body).hexdigest() if full
                                     else head.get("warc-payload-digest", "").removeprefix("sha1:"),
                                     body if full else None)[:len(names)])
                        held += len(body) * payloads
                        if held > 32 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
              + ", payload binary" * payloads)
    return spread.mapInArrow(read, schema)


def archive_and_read(pages: DataFrame, least_bytes: int = 1000, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back."""
    path = shared_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, path, least_bytes), range_bytes)

"""WARC archives through a chunked record table.

A payload is a run of rows (record, chunk number, bytes), none longer than CHUNK, on the
way into an archive and out of it.  Writer and reader hold one chunk at a time and carry
the digest and length of all bytes so far; the last row of a record has those of the
whole payload.  Payloads go from their table to a spool file a task, chunk by chunk; only
their places, lengths and digests are joined, and each archive takes its records' chunks
from the spools.  Each task writes one archive, a gzip member a record.  Spools and
archives lie in the folder all executors share; a task that runs again writes another
file, and only the files in the stored lists count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import zlib
from typing import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamsync.llm.common import small_batches, stored
from streamsync.scratch import work_dir

CHUNK = 1 << 16
#: Payloads shorter than this are stored each for itself.
LEAST_SHARED = 1000
#: Tasks over which the records of one digest are dealt.
SALTS = 16
#: Before each chunk of a spool file: its bytes there, and its bytes unpacked.
_FRAME, _FRAME_BYTES = "<II", 8
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SPOOLED = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("n_bytes", pa.int64()), ("digest", pa.string()),
        ("spool", pa.string()), ("start", pa.int64()),
    ]
)
ARCHIVE = pa.schema([("path", pa.string()), ("records", pa.int64()), ("stored_bytes", pa.int64())])
CHUNKS = pa.schema(
    [
        ("path", pa.string()), ("record", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("chunk", pa.int64()),
        ("content", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
        ("last", pa.bool_()),
    ]
)


def chunked(pages: DataFrame) -> DataFrame:
    """The record table: page_id, url, chunk, content; a row for each CHUNK bytes of a
    payload, in order; one for none.  A null html is an empty payload."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    last = F.greatest(F.floor((F.octet_length("payload") - 1) / CHUNK), F.lit(0)).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring("payload", i * CHUNK + 1, F.lit(CHUNK))
    )
    return rows.select("page_id", "url", F.posexplode(parts).alias("chunk", "content"))


def spooled(chunks: DataFrame) -> DataFrame:
    """Write a record table's payloads to spool files; page_id, url, n_bytes, digest and
    place (spool, start) of each record.  The rows of a record follow each other."""
    spark = chunks.sparkSession
    small_batches(spark)
    folder = work_dir(spark, "spool")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = fs.FileSystem.from_uri(folder)
        task, codec = TaskContext.get(), pa.Codec("zstd", 1)
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        file, record, sha, at = None, None, None, 0
        for batch in batches:
            done = []
            pages, urls, numbers, contents = (batch.column(c) for c in ("page_id", "url", "chunk", "content"))
            for i in range(batch.num_rows):
                file = file or system.open_output_stream(f"{place}/{name}", compression=None)
                if numbers[i].as_py() == 0:
                    if record:
                        done.append(record | {"digest": sha.hexdigest()})
                    sha = hashlib.sha1()
                    record = {
                        "page_id": pages[i].as_py(), "url": urls[i].as_py(), "n_bytes": 0,
                        "spool": f"{folder}/{name}", "start": at,
                    }
                if content := contents[i].as_py():
                    packed = codec.compress(content, asbytes=True)
                    sha.update(content)
                    file.write(struct.pack(_FRAME, len(packed), len(content)))
                    file.write(packed)
                    record["n_bytes"] += len(content)
                    at += _FRAME_BYTES + len(packed)
            yield pa.RecordBatch.from_pylist(done, SPOOLED)
        if file:
            file.close()
            yield pa.RecordBatch.from_pylist([record | {"digest": sha.hexdigest()}], SPOOLED)

    schema = "page_id long, url string, n_bytes long, digest string, spool string, start long"
    return stored(chunks.mapInArrow(write, schema), "spool-list")


def _payload(file: pa.NativeFile, start: int, size: int) -> Iterator[bytes]:
    """The chunks of a payload in a spool file."""
    codec = pa.Codec("zstd")
    file.seek(start)
    while size:
        frame = file.read(_FRAME_BYTES)
        if len(frame) < _FRAME_BYTES:
            raise EOFError(f"a spool file ends {size} bytes before its record")
        packed, plain = struct.unpack(_FRAME, frame)
        yield codec.decompress(file.read(packed), plain, asbytes=True)
        size -= plain


def deduplicated(records: DataFrame) -> DataFrame:
    """The records of ``spooled`` and their ``refers_to``.

    Of equal payloads of LEAST_SHARED bytes or more, the rows with the largest page_id
    keep the payload; the others refer to that page.  Rows without a page_id never do
    others' work: they refer, or keep theirs if no row of the group has an id.
    """
    groups = (
        records.filter(F.col("n_bytes") >= LEAST_SHARED)
        .groupBy(F.col("digest").alias("shared"))
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1 and keeper is not null")
        .select("shared", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    )
    salted = records.withColumn("salt", F.pmod(F.xxhash64("spool", "start"), F.lit(SALTS)))
    same = (F.col("digest") == F.col("shared")) & (F.col("salt") == F.col("part"))
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("keeper"))
    refers = F.when(F.col("keeper").isNotNull() & other, F.col("keeper"))
    return salted.join(groups, same, "left").select(*records.columns, refers.alias("refers_to"))


def _heads(row: dict) -> bytes:
    """The WARC and HTTP headers of a record."""
    length = row["n_bytes"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
    revisit = row["refers_to"] is not None
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    page = "none" if row["page_id"] is None else row["page_id"]
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{page}>",
        "WARC-Target-URI": None if row["url"] is None else quote(row["url"], safe="%!#$&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": f"<urn:page:{row['refers_to']}>" if revisit else None,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(http) + (0 if revisit else length),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n{http}".encode()


def write_archives(records: DataFrame) -> DataFrame:
    """Write the records of ``deduplicated``, as many archives as there are spool files;
    path, records and stored_bytes of every archive."""
    spark = records.sparkSession
    small_batches(spark)
    folder = work_dir(spark, "archives")
    records = stored(records, "records")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        path = f"{place}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        file, spool, opened, count = None, None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                file = file or system.open_output_stream(path, compression=None)
                packer, count = zlib.compressobj(6, zlib.DEFLATED, 31), count + 1
                file.write(packer.compress(_heads(row)))
                if row["refers_to"] is None:
                    if spool != row["spool"]:
                        if opened:
                            opened.close()
                        spool = row["spool"]
                        source, at = fs.FileSystem.from_uri(spool)
                        opened = source.open_input_file(at)
                    for content in _payload(opened, row["start"], row["n_bytes"]):
                        file.write(packer.compress(content))
                file.write(packer.compress(b"\r\n\r\n") + packer.flush())
        if opened:
            opened.close()
        if file:
            size = file.tell()
            file.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": f"{folder}/{path.rpartition('/')[2]}", "records": count, "stored_bytes": size}], ARCHIVE
            )

    archives = max(1, records.select("spool").distinct().count())
    dealt = records.repartitionByRange(archives, "spool", "start").sortWithinPartitions("spool", "start")
    return stored(dealt.mapInArrow(write, "path string, records long, stored_bytes long"), "archive-list")


def _read(path: str) -> Iterator[dict]:
    """The chunk rows of an archive."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place, compression=None) as raw, gzip.GzipFile(fileobj=raw) as file:
        number = 0
        while (line := file.readline(1024)) in (b"\r\n", b"WARC/1.1\r\n"):
            if line == b"\r\n":
                continue
            fields = _fields(file)
            left = int(fields["content-length"])
            http, size = _fields(file, counted := []), 0
            left -= sum(counted)
            page = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
            refers = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
            row = {
                "path": path, "record": number, "page_id": None if page == "none" else int(page),
                "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
                "refers_to": int(refers) if refers else None,
            }
            number, sha, chunk = number + 1, hashlib.sha1(), 0
            if row["record_type"] == "revisit":  # the payload is the other record's
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                yield row | {
                    "chunk": 0, "content": b"", "bytes_so_far": int(http["content-length"]),
                    "digest_so_far": digest, "last": True,
                }
                continue
            while True:
                content = file.read(min(CHUNK, left))
                if left and not content:
                    raise EOFError(f"{path} ends within record {number - 1}")
                left, size = left - len(content), size + len(content)
                sha.update(content)
                yield row | {
                    "chunk": chunk, "content": content, "bytes_so_far": size,
                    "digest_so_far": sha.hexdigest(), "last": not left,
                }
                chunk += 1
                if not left:
                    break
        if line:
            raise ValueError(f"{path}: no record begins after record {number - 1}")


def _fields(file, counted: list[int] | None = None) -> dict[str, str]:
    """Header lines up to an empty one; names in lower case."""
    found = {}
    while (line := file.readline(1 << 20)) not in (b"\r\n", b""):
        if counted is not None:
            counted.append(len(line))
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    if counted is not None:
        counted.append(len(line))
    return found


def read_archives(archives: DataFrame) -> DataFrame:
    """The chunked record table of a list of archives (column ``path``)."""
    small_batches(archives.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for row in _read(path):
                    rows.append(row)
                    held += len(row["content"]) + 500
                    if held > 64 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, CHUNKS)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, CHUNKS)

    schema = (
        "path string, record long, page_id long, url string, record_type string, refers_to long, "
        "chunk long, content binary, bytes_so_far long, digest_so_far string, last boolean"
    )
    paths = archives.select("path")
    return paths.repartition(max(1, paths.count()), F.rand(0)).mapInArrow(read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as the
    archives have it.  A null html is an empty payload; a url is kept with any character
    that a header can't hold percent-encoded.  Repeated rows are records each."""
    chunks = read_archives(write_archives(deduplicated(spooled(chunked(pages)))))
    return chunks.filter("last").select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )

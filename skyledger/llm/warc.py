"""Web archives: one gzip member per record, written and read record by record.

``write`` stores pages as ``*.warc.gz`` files below a shared folder, one file per task. Of pages with
equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest page_id becomes a response
record; the others become revisit records, which name it and keep only their protocol header. Equal
payloads are found by digest with a pre-aggregated group per digest, so that a payload of many pages meets
in no single task. A task writes to a name of its own attempt and renames when the file is complete.

``read`` streams each archive of a folder from its start, whatever its size: a task holds one piece of it
and one record. A member is decompressed piece by piece, its record
framed by the content length, and block and payload digests are verified.

Edge cases: a NULL payload is the empty one; a NULL url has no target header and comes back NULL; a NULL
page_id comes back NULL and sorts lowest among equal payloads. Rows that repeat a page and its payload are
all responses if that page_id is the largest. Line breaks in a url are percent-encoded. An archive of no
pages has no records. A record cut off, wrongly framed or with a wrong digest comes back with ``verified``
false. Extra columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.llm.store import shared_path, staged

REVISIT_BYTES = 1000
LEVEL = 4
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
# Fixed value: the profile a revisit by equal payload names.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id, url, payload: bytes, sha1: bytes, refers_to, revisit: bool, date: str) -> bytes:
    """One record without compression."""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {uri(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [
        f"WARC-Date: {date}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(sha1).decode(),
        f"WARC-Block-Digest: {digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {uri(refers_to)}"]
    return "\r\n".join(head).encode() + END + block + END


def member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, sha1, refers_to, revisit of each page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select("page_id", "url", payload.alias("payload"))
    own = own.withColumn("sha1", F.sha1("payload"))
    big = F.length("payload") >= REVISIT_BYTES
    # The digests are 1:1 with payloads; only those of two or more rows leave the aggregation.
    groups = own.filter(big).groupBy(F.col("sha1").alias("equal"))
    groups = groups.agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    # Small payloads match nothing; keys of their own spread them over the tasks.
    key = F.when(big, F.col("sha1")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    joined = own.withColumn("key", key).join(groups, F.col("key") == F.col("equal"), "left")
    revisit = F.col("equal").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select("page_id", "url", "payload", "sha1", "refers_to", revisit.alias("revisit"))


def write(pages: DataFrame, folder: str, level: int = LEVEL, date: str = DATE) -> DataFrame:
    """Write the archives below ``folder`` (a URI every executor can write to); returns the list of
    files with their records and bytes."""
    store, root = pa.fs.FileSystem.from_uri(folder)
    store.create_dir(root)

    def write_part(batches):
        store, root = pa.fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        own = f"{root}/.{name}.{uuid.uuid4().hex}"
        out, records, size = None, 0, 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6)), strict=True):
                page_id, url, payload, sha1, refers_to, revisit = (v.as_py() for v in row)
                data = member(record(page_id, url, payload, bytes.fromhex(sha1), refers_to, revisit, date), level)
                out = out or store.open_output_stream(own)
                out.write(data)
                records, size = records + 1, size + len(data)
        if out:
            out.close()
            store.move(own, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records]), pa.array([size])], NAMES)

    NAMES = ["file", "records", "bytes"]  # noqa: N806
    return staged(planned(pages).mapInArrow(write_part, "file string, records long, bytes long"), "archives")


def members(archive) -> Iterator[tuple[bytes, bool]]:
    """Contents of the gzip members in order, and whether each one is complete. ``archive`` is bytes or
    an open file, which is read forward only and of which at most ``CHUNK`` bytes are held."""
    stream = archive if hasattr(archive, "read") else io.BytesIO(archive)
    chunk = stream.read(CHUNK)
    while chunk:
        unpacker, pieces = zlib.decompressobj(31), []
        try:
            while chunk and not unpacker.eof:
                pieces.append(unpacker.decompress(chunk))
                chunk = unpacker.unused_data or stream.read(CHUNK)
        except zlib.error:
            yield b"".join(pieces), False
            return
        yield b"".join(pieces), unpacker.eof


def parsed(data: bytes, complete: bool) -> dict:
    """Fields of one record."""
    head, _, rest = data.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    size = int(fields.get("content-length", "-1")) if fields.get("content-length", "").isdigit() else -1
    block, tail = rest[: max(size, 0)], rest[max(size, 0) :]
    http, _, payload = block.partition(END)
    length = [v for k, _, v in (x.partition(": ") for x in http.decode("latin-1").split("\r\n")) if k.lower() == "content-length"]
    revisit = fields.get("warc-type") == "revisit"
    sha1 = fields.get("warc-payload-digest", "")
    verified = (
        complete
        and lines[0].startswith("WARC/")
        and len(block) == size
        and tail == END
        and digest(block) == fields.get("warc-block-digest")
        and (revisit or digest(payload) == sha1 and length == [str(len(payload))])
    )
    known = sha1.startswith("sha1:") and len(sha1) == 37
    return {
        "page_id": page_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload_bytes": int(length[0]) if length and length[0].isdigit() else None,
        "payload_digest": base64.b32decode(sha1[5:]).hex() if known else None,
        "verified": verified,
        "payload": None if revisit else payload,
    }


FIELDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, verified boolean, payload binary"
)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives of a folder; without ``payloads`` all fields but the payload."""
    fields = FIELDS if payloads else FIELDS.removesuffix(", payload binary")
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [f.split()[0] for f in fields.split(", ")]

    def read_all(batches):
        store, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as archive:
                    for data, complete in members(archive):
                        rows.append(parsed(data, complete))
                        size += len(data)
                        if size >= 4 * W.SLICE_BYTES:
                            yield as_batch(rows)
                            rows, size = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        arrays = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=False)]
        return pa.RecordBatch.from_arrays(arrays, names)

    # Only names are read here, so that Spark deals the archives to tasks by their sizes.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1)).mapInArrow(read_all, fields)


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """Archive every page and read the archives back."""
    folder = shared_path(spark, "warc")
    folder = folder if "://" in folder else "file://" + os.path.abspath(folder.removeprefix("file:"))
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )

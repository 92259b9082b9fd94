"""WARC archives: one gzip member per record, written and read sequentially.

Each Spark task writes its own archive files into a shared folder through the
Arrow file systems (local, HDFS, S3, ...), under a name of its attempt, so a
retried task leaves a file that no manifest names.  The reader streams an
archive member by member: incremental zlib decompression, framing by
Content-Length, and SHA-1 digests of block and payload checked for every record.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, stage

# Record header names and values of the WARC format, version 1.1.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ID = "urn:page:"
_DATE = "2024-01-01T00:00:00Z"  # one date for all records: a rerun writes the same bytes
READ_BYTES = 1 << 18


class WarcError(ValueError):
    """An archive that breaks the format or whose digests don't match."""


def _uri(url: str | None) -> str | None:
    """A header value must be one line of printable characters."""
    if url is None:
        return None
    return "".join(c if 0x20 < ord(c) < 0x7F else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def encode_record(
    record_id: str, record_type: str, url: str | None, payload: bytes, digest: str, refers_to: str | None
) -> bytes:
    """One record as a gzip member.  A revisit keeps the HTTP headers only;
    its HTTP Content-Length and payload digest are those of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("ascii") + (payload if record_type == "response" else b"")
    head = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", f"<{_ID}{record_id}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("WARC-Profile", REVISIT_PROFILE if record_type == "revisit" else None),
        ("WARC-Refers-To", f"<{_ID}{refers_to}>" if refers_to is not None else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None).encode("ascii")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(source: BinaryIO) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time; only the
    current member is held."""
    rest = b""
    while True:
        rest = rest or source.read(READ_BYTES)
        if not rest:
            return
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest and not (rest := source.read(READ_BYTES)):
                raise WarcError("the archive ends inside a record")
            parts.append(unpack.decompress(rest))
            rest = unpack.unused_data
        yield b"".join(parts)


def _headers(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError("a header line without a colon")
        found[name.decode("ascii").lower()] = value.strip().decode("utf-8")
    return found


def decode_record(member: bytes) -> dict:
    """Check and take apart one record: headers, HTTP headers and payload."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version != VERSION or not gap:
        raise WarcError("not a WARC record")
    fields = _headers(lines)
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError("the block is not as long as Content-Length")
    block = rest[:size]
    if fields["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise WarcError("the block digest does not match")
    http, _, payload = block.partition(b"\r\n\r\n")
    web = _headers(http.partition(b"\r\n")[2])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (
        hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(web["content-length"])
    ):
        raise WarcError("the payload digest or length does not match")
    return {
        "record_id": _page(fields["warc-record-id"]),
        "record_type": fields["warc-type"],
        "url": fields.get("warc-target-uri"),
        "payload": payload,
        "payload_bytes": int(web["content-length"]),
        "payload_digest": digest,
        "refers_to": _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
    }


def _page(record_id: str) -> int | None:
    found = record_id.removeprefix(f"<{_ID}").removesuffix(">")
    return int(found) if found != "none" else None


def _store(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def decide_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Payload, digest, type and reference of the record of every page.

    Of equal payloads of at least ``least_bytes`` bytes the page with the
    largest page_id is the response (pages that repeat that id too); the rest
    revisit it.  A null page_id counts as smallest; if a group has no other
    id, all its pages are responses.  A null html is an empty payload.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha1(F.col("payload"))
    )
    # one narrow row per repeated payload; map-side sums carry a hot payload
    shared = (
        pages.select("page_id", payload.alias("_p"))
        .where(F.octet_length("_p") >= least_bytes)
        .groupBy(F.sha1("_p").alias("_digest"))
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) & F.col("_last").isNotNull())
        .drop("_n")
    )
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return rows.join(shared, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_last")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, roll_bytes: int = 1 << 30) -> DataFrame:
    """Write records into archives under ``folder``; return the manifest
    (path, records, bytes), one row per archive.

    An archive is closed once it holds ``roll_bytes`` compressed bytes.
    """

    def write(batches):
        store, root = _store(folder)
        out, path, count, size = None, "", 0, 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, count, size = store.open_output_stream(path, compression=None), 0, 0
                page = "none" if pd.isna(r.page_id) else str(int(r.page_id))
                other = None if pd.isna(r.refers_to) else str(int(r.refers_to))
                url = r.url if isinstance(r.url, str) else None
                data = encode_record(page, r.record_type, url, bytes(r.payload), r.digest, other)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= roll_bytes:
                    out.close()
                    yield pd.DataFrame({"path": [path], "records": [count], "bytes": [size]})
                    out = None
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "records": [count], "bytes": [size]})

    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    # ids as text: they stay exact where a batch also holds nulls
    narrow = records.select(
        F.col("page_id").cast("string"), "url", "payload", "digest", "record_type",
        F.col("refers_to").cast("string"),
    )
    return stage(narrow.mapInPandas(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Read every archive of a manifest in sequence: one row per record
    (page_id, record_type, url, payload, payload_bytes, payload_digest,
    refers_to).  Raises WarcError on any breach of framing or digest."""
    schema = (
        "page_id long, record_type string, url string, payload binary,"
        " payload_bytes long, payload_digest string, refers_to long"
    )

    def read(batches):
        import pyarrow as pa

        store, _ = _store(folder)
        arrow = pa.schema(
            [("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
             ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for member in members(source):
                        record = decode_record(member)
                        record["page_id"] = record.pop("record_id")
                        rows.append(record)
                        held += len(member)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    # a task an archive: adaptive execution would merge so few rows into one
    paths = manifest.select("path").repartition(max(1, manifest.count()))
    return paths.mapInArrow(read, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder; removed when the application ends."""
    path = f"{prepare(spark)}/warc-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path

"""WARC archives compressed record by record with a shared Zstandard dictionary.

A dictionary is trained on a bounded sample of the records to be archived and stands in a skippable frame at the head
of every archive; after it, each record is a frame of its own, so a reader that knows an offset can start there.

Of the records with equal payloads (SHA-1 and size) of at least ``least_bytes`` bytes, the one with the largest
page_id is the response; the others are revisits that name it. The largest id of a payload is found by an aggregation
that is combined before its shuffle; only payloads that occur twice are joined back, and pages stay where they are
unless those are too many to broadcast.

Archives are written by tasks into a folder that all executors share, each under a name of its own, and closed at
``archive_bytes``. The manifest is a table written by Spark: a task that is lost and run again leaves a file that no
manifest names. ``read`` takes every archive of the manifest apart and checks each response against its digest.

Defined cases: a null html is an empty payload. Rows with equal id and payload are one capture, all of them
responses. A null page_id is smaller than any other; payloads that only null ids have are all responses. A null url
is left out. An empty table gives no archive. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import land, ship
from millrace.session import scratch_path
from millrace.sources.heads import arrow_path

#: Fixed values of the formats: magic number of the dictionary's frame, profile of revisits.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:page:"


@dataclass(frozen=True)
class Settings:
    """``sample_records`` records of at most ``sample_bytes`` each are what the dictionary is trained on."""

    least_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6
    dictionary_bytes: int = 64 << 10
    sample_records: int = 400
    sample_bytes: int = 16 << 10
    archive_bytes: int = 32 << 20
    broadcast_rows: int = 200_000


PRODUCTION = Settings()


def _headers(first: str, pairs: list[tuple[str, object]]) -> bytes:
    return "".join([f"{first}\r\n", *(f"{k}: {v}\r\n" for k, v in pairs if v is not None), "\r\n"]).encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, settings: Settings) -> bytes:
    """A response with its payload, or a revisit with the headers alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = _headers("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    block += payload if refers_to is None else b""
    uri = None if url is None else "".join(c for c in url if c.isprintable() and c != " ")
    head = _headers(
        "WARC/1.1",
        [
            ("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<{PAGE}{'' if page_id is None else page_id}>"),
            ("WARC-Date", settings.date),
            ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Refers-To", None if refers_to is None else f"<{PAGE}{refers_to}>"),
            ("WARC-Profile", None if refers_to is None else PROFILE),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ],
    )
    return head + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary; where there is too little to train on, the records themselves serve as one."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _plan(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(page_id, url, payload, digest, size) of every page."""
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    plain = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    return plain.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})


def write(
    spark: SparkSession,
    pages: DataFrame,
    root: str | None = None,
    settings: Settings = PRODUCTION,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Writes the archives under ``root`` (a folder that all executors reach); returns the manifest: path, n_records,
    n_bytes."""
    ship(spark)
    root = root or scratch_path(spark, "warc")
    plain = _plan(pages, page_id, url, html)
    again = plain.groupBy("digest", "size").agg(F.count("*").alias("n"), F.max("page_id").alias("last"))
    again = land(spark, again.where(f"n > 1 AND size >= {settings.least_bytes}").select("digest", "size", "last"), "warc-repeated")
    few = again.count() <= settings.broadcast_rows
    named = plain.join(F.broadcast(again) if few else again, ["digest", "size"], "left")
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    rows = named.select("page_id", "url", "payload", refers.alias("refers_to"))

    total = max(1, plain.count())
    pick = F.pmod(F.xxhash64("page_id", "digest"), F.lit(1_000_003)) < min(1.0, settings.sample_records / total) * 1_000_003
    sampled = plain.where(pick).select("page_id", "url", F.substring("payload", 1, settings.sample_bytes).alias("payload"))
    got = sampled.limit(2 * settings.sample_records).collect()  # bounded by the settings
    dictionary = train([record(r["page_id"], r["url"], bytes(r["payload"]), None, settings) for r in got], settings.dictionary_bytes)

    def run(batches):
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(arrow_path(root))
        store.create_dir(folder, recursive=True)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=settings.level, dict_data=shared, write_checksum=True, write_content_size=True)
        out, name, n, size = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "n_records": [n], "n_bytes": [size]})

        for batch in batches:
            for id_, url_, payload_, refers_ in zip(*batch.columns, strict=True):
                if out is None:
                    name, n, size = f"{folder}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = store.open_output_stream(name, compression=None)
                    out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                raw = record(id_.as_py(), url_.as_py(), payload_.as_py(), refers_.as_py(), settings)
                frame = pack.compress(raw)
                out.write(frame)
                n, size = n + 1, size + len(raw)
                if size >= settings.archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    manifest = rows.mapInArrow(run, "path string, n_records long, n_bytes long").withColumn("root", F.lit(root))
    return land(spark, manifest, "warc-manifest")


def frames(source) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of each frame of an archive, read from its head in pieces."""
    magic, length = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive doesn't begin with its dictionary")
    dictionary = source.read(length)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    unpack = zstandard.ZstdDecompressor(dict_data=shared)
    at, rest = 8 + length, b""
    while True:
        one, parts, start = unpack.decompressobj(), [], at
        while not one.eof:
            rest = rest or source.read(1 << 20)
            if not rest:
                if parts or at > start:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(one.decompress(rest))
            at += len(rest) - len(one.unused_data)
            rest = one.unused_data
        yield start, b"".join(parts)


def parse(raw: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload (None for a revisit) of a record."""
    head, block = raw.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    said = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload doesn't have its digest")
    page = lambda v: int(x) if (x := v.removeprefix(f"<{PAGE}").removesuffix(">")) else None
    return {
        "page_id": page(fields["WARC-Record-ID"]),
        "payload_bytes": int(said["Content-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        "payload": payload if kind == "response" else None,
    }


def read(spark: SparkSession, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, archive,
    record_offset, and the payload if asked for."""
    ship(spark)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "record_offset", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True))[: len(names) - (not payloads)])

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for path, root in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, _ = fs.FileSystem.from_uri(arrow_path(root))
                with store.open_input_stream(path, compression=None) as source:
                    held, size = [], 0
                    for at, raw in frames(source):
                        row = parse(raw) | {"archive": path.rpartition("/")[2], "record_offset": at}
                        held.append({k: row[k] for k in schema.names})
                        size += len(raw) if payloads else 200
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, schema)

    tasks = max(1, min(manifest.count(), 100_000))
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, record_offset long"
    return manifest.select("path", "root").repartition(tasks, "path").mapInArrow(run, kind + ", payload binary" * payloads)

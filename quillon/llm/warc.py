"""WARC archives whose records are Zstandard frames that share a dictionary, and reading them back.

File layout (the public "Zstandard compression for WARC" format): a skippable frame with magic number
0x184D2A5D that holds the dictionary, then one frame per record.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.session import Scratch, spread

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"

LEAST_REVISIT = 100
DICTIONARY_BYTES = 64 * 1024
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 16 * 1024
ARCHIVE_BYTES = 1 << 30

RECORD = "page_id bigint, url string, payload binary, digest string, payload_bytes bigint, record_type string, refers_to bigint"
FOUND = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def mark_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Records to write: of equal payloads of at least ``least`` bytes the smallest page_id is the response, others revisit it.

    NULL html is an empty payload. Equal page_ids with equal payloads: all rows with the smallest id are
    responses. A NULL page_id never is the smallest unless all are NULL.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    # only payloads that occur twice lead anywhere; the counts are small rows, made before any join
    first = rows.where(F.col("payload_bytes") >= least).groupBy("digest").agg(
        F.min("page_id").alias("__first"), F.count("*").alias("__n")).where(F.col("__n") > 1).drop("__n")
    joined = rows.join(first, "digest", "left")
    later = F.coalesce(F.col("__first") != F.coalesce("page_id", F.lit(-1)), F.lit(False))
    return joined.select(
        "page_id", "url", F.when(~later, F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "digest", "payload_bytes",
        F.when(later, "revisit").otherwise("response").alias("record_type"), F.when(later, F.col("__first")).alias("refers_to"))


def train_dictionary(pages: DataFrame, records_limit: int = SAMPLE_RECORDS, bytes_limit: int = SAMPLE_BYTES) -> bytes:
    """A dictionary from a bounded sample of the payloads to archive: about ``records_limit``, ``bytes_limit`` of each.

    Pages are chosen by a hash of their id, each with the same chance. A sample too small or too uniform to
    train on serves as a raw dictionary itself; without any payload the dictionary is empty.
    """
    share = min(1.0, records_limit / max(1, pages.count()))
    chosen = pages.where(F.pmod(F.xxhash64(F.col("page_id").cast("bigint")), F.lit(1 << 31)) < int(share * (1 << 31)))
    part = F.substring(F.encode(F.col("html").cast("string"), "utf-8"), 1, bytes_limit).alias("part")
    parts = sorted(bytes(r["part"]) for r in chosen.where(F.length("html") > 0).select(part).limit(2 * records_limit).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


def _header(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, kind: str, refers_to: int | None) -> bytes:
    """One WARC record. Control characters in a URL are percent-encoded, so that no header can be forged."""
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(size)),
        ("Content-Type", "text/html; charset=utf-8")]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if kind == "revisit":
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", PROFILE)]
    return _header(fields, len(payload)) + payload + b"\r\n\r\n"


def write_archive(out: BinaryIO, records: Iterator[tuple], dictionary: bytes, most: int = ARCHIVE_BYTES) -> int:
    """Write records until the file holds ``most`` bytes or they end; the number written."""
    written = count = 0
    compressor = zstandard.ZstdCompressor(level=6, dict_data=_dictionary(dictionary), write_content_size=True)
    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
    for record in records:
        frame = compressor.compress(record_bytes(*record))
        out.write(frame)
        count += 1
        written += len(frame)
        if written >= most:
            break
    return count


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def read_archive(source: BinaryIO) -> Iterator[tuple]:
    """Records of an archive, one frame in memory at a time: the values of ``FOUND``."""
    magic, length = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(source.read(length)))
    pending = b""
    while True:
        frame, record = decompressor.decompressobj(), []
        while not frame.eof:
            pending = pending or source.read(1 << 18)
            if not pending:
                if record:
                    raise ValueError("the archive ends inside a record")
                return
            record.append(frame.decompress(pending))
            pending = frame.unused_data if frame.eof else b""
        yield parse_record(b"".join(record))


def parse_record(data: bytes) -> tuple:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = body[: int(fields["Content-Length"])]
    own, other = fields["WARC-Record-ID"][len(ID_PREFIX) + 1 : -1], fields.get("WARC-Refers-To")
    return (
        int(own) if own else None, int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        fields["WARC-Type"], int(other[len(ID_PREFIX) + 1 : -1]) if other else None, payload)


def verified(record: tuple) -> tuple:
    """A record as it was read, with length and SHA-256 of a response's payload taken from the payload itself.

    Where its headers say otherwise, the record is damaged and an error. Of a revisit, the archive has no payload to measure.
    """
    page_id, size, digest, kind, refers_to, payload = record
    if kind != "response":
        return record
    found = len(payload), hashlib.sha256(payload).hexdigest()
    if found != (size, digest):
        raise ValueError(f"the payload of page {page_id} has {found[0]} bytes and digest {found[1]}, its headers say {size} and {digest}")
    return page_id, *found, kind, refers_to, payload


def write_archives(records: DataFrame, folder: str, dictionary: bytes, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each partition as one or more archives into ``folder`` (shared by all executors); (archive, n_records) per file.

    A file is written under its attempt's name and then moved to its own, so a retried or doubled task
    leaves whole archives with the same records. The folder may be in any file system pyarrow reaches.
    """
    broadcast = records.sparkSession.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        context = TaskContext.get()
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        rows = (tuple(row.values()) for batch in batches for row in batch.to_pylist())
        part = 0
        for first in rows:
            name = f"{base}/part-{context.partitionId():06d}-{part:04d}.warc.zst"
            with system.open_output_stream(f"{name}.{context.taskAttemptId()}", compression=None) as out:
                count = write_archive(out, itertools.chain([first], rows), broadcast.value, most)  # closes nothing: rows go on in the next file
            system.move(f"{name}.{context.taskAttemptId()}", name)
            part += 1
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["archive", "n_records"])

    return records.mapInArrow(write, "archive string, n_records bigint")


def read_archives(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the archives listed in the column ``archive``, ``verified``; payloads only on request."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][: 6 if payloads else 5]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                with system.open_input_stream(path, compression=None) as source:
                    rows = []
                    for record in map(verified, read_archive(source)):
                        rows.append(record)
                        if len(rows) == 256:
                            yield _batch(rows, names, types)
                            rows = []
                    if rows:
                        yield _batch(rows, names, types)

    fields = FOUND.split(", ")
    return archives.select("archive").mapInArrow(read, ", ".join(fields if payloads else fields[:-1]))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def archive_pages(pages: DataFrame, scratch: Scratch, payloads: bool = False) -> DataFrame:
    """Write every page as a WARC record and read all archives back: one row per page.

    Payloads: html in UTF-8 (NULL: empty). Full payloads are stored once; a revisit record carries the
    digest and length of the full payload and the id of its response. NULL urls have no target header.
    Repeated rows give a record each; other columns are not looked at. An empty table gives an empty
    result and no archive.
    """
    records = mark_revisits(spread(pages)).select(*[f.split()[0] for f in RECORD.split(", ")])
    folder = scratch.path("archives")
    archives = scratch.keep(write_archives(records, folder, train_dictionary(pages)))
    return read_archives(spread_files(archives), folder, payloads)


def spread_files(archives: DataFrame) -> DataFrame:
    """One archive a task, as far as there are cores for: a row stands for a whole file."""
    return archives.repartition(max(1, min(archives.count(), 4096)))

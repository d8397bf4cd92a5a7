"""WARC archives in Zstandard form: written by tasks, read back record by record.

An archive is a skippable frame with the archive's dictionary, then one frame per
record. Archives are files in a folder that every executor reaches; Spark's
binary file source reads them back.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.batches import bound_batches
from ledgerloom.session import scratch_path, settle

# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
DIGEST_PREFIX = "sha1:"
ID_PREFIX = "<urn:ledgerloom:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"

SUFFIX = ".warc.zst"
# Bytes of payload after which a task starts its next archive, so that one
# archive fits a task's memory when it is read.
ARCHIVE_BYTES = 8 << 20
# Dictionary of an archive: its size, and the bytes of its first payloads it is fitted on.
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20
STEP = 1 << 14


class WarcError(ValueError):
    """An archive or record that breaks the format."""


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(value: str | None) -> str:
    """A value on one line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value or "")


def fit_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for an archive; the joined samples where there are too few to fit one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _as_dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def dictionary_frame(data: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(data)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(packed)) + packed


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION] + [f"{k}: {_header_value(v)}".encode() for k, v in headers.items()]
    lines.append(f"Content-Length: {len(block)}".encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """A response, or with ``first`` a revisit of that page without the payload."""
    headers = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": f"{ID_PREFIX}{'' if page_id is None else page_id}>",
        "WARC-Date": RECORD_DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": DIGEST_PREFIX + payload_digest(payload),
        "Content-Type": "application/http; msgtype=response",
    }
    if first is not None:
        headers["WARC-Profile"] = PROFILE
        headers["WARC-Refers-To"] = f"{ID_PREFIX}{first}>"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    return record_bytes(headers, http + (payload if first is None else b""))


def archive_bytes(records: list[bytes], samples: list[bytes]) -> bytes:
    dictionary = fit_dictionary(samples)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=_as_dictionary(dictionary))
    return dictionary_frame(dictionary) + b"".join(compressor.compress(r) for r in records)


def _leading_dictionary(data: memoryview) -> tuple[bytes, int]:
    """The dictionary and where the first record starts; no skippable frame, no dictionary."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE_MAGIC:
        return b"", 0
    size = struct.unpack_from("<I", data, 4)[0]
    if 8 + size > len(data):
        raise WarcError("the dictionary frame is cut short")
    content = bytes(data[8 : 8 + size])
    if content[:4] == FRAME_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return content, 8 + size


def parse_record(raw: bytes) -> Record:
    """Headers and block of one record; its version, headers and length are checked."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError("no WARC header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name:
            raise WarcError("a header line without a name")
        headers[name.decode().strip().lower()] = value.decode().strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name}")
    if not headers["content-length"].isdigit():
        raise WarcError("content-length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("content-length does not fit the record")
    return Record(headers, rest[:length])


def read_archive(data: bytes) -> Iterator[tuple[int, Record]]:
    """``offset, record`` of an archive, one Zstandard frame each."""
    view = memoryview(data)
    content, at = _leading_dictionary(view)
    decompressor = zstandard.ZstdDecompressor(dict_data=_as_dictionary(content))
    while at < len(view):
        frame, start, parts = decompressor.decompressobj(), at, []
        while not frame.eof:
            if at >= len(view):
                raise WarcError("the last frame is cut short")
            try:
                parts.append(frame.decompress(view[at : at + STEP]))
            except zstandard.ZstdError as error:
                raise WarcError(f"a broken frame at {start}") from error
            at = min(at + STEP, len(view)) - len(frame.unused_data)
        yield start, parse_record(b"".join(parts))


def _whole_address(spark: SparkSession, folder: str) -> str:
    """The folder's address with its file system, as Spark's own readers see it.

    A bare path is one of the default file system, which executors that only know
    the path would look for on their own disks.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


def _open_folder(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", address))


def _write_archives(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open_folder(folder)
        records: list[bytes] = []
        samples: list[bytes] = []
        size = sampled = 0

        def close() -> pa.RecordBatch:
            # A name of its own for every attempt: what a lost task left is never read.
            name = f"{uuid.uuid4().hex}{SUFFIX}"
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(archive_bytes(records, samples))
            return pa.RecordBatch.from_pydict({"file": [name], "records": [len(records)]})

        for batch in batches:
            for row in zip(*[batch.column(i) for i in range(4)]):
                page_id, url, payload, first = (value.as_py() for value in row)
                records.append(page_record(page_id, url, payload, first))
                size += len(payload)
                if sampled < SAMPLE_BYTES and first is None:
                    samples.append(payload)
                    sampled += len(payload)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    records, samples, size, sampled = [], [], 0, 0
        if records:
            yield close()

    return write


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Write the pages to archives in ``folder``; ``file, records`` of those that count.

    A payload is the html in UTF-8, NULL is empty. Of rows with equal payloads
    of at least ``min_bytes`` bytes the one with the largest id becomes a
    response and the others revisits of it; shorter payloads are all responses,
    as are payloads of which no row has an id and repeated rows of the largest
    id. Payloads are equal when their SHA-256 and lengths are. Other columns
    are not written. No rows give no archives.

    The largest id per payload is combined per task before it shuffles; the
    join that brings it to the pages is adaptive and splits a payload that a
    third of all pages share.
    """
    bound_batches(pages.sparkSession)
    payload = F.coalesce(F.encode(html_col, "UTF-8"), F.lit(b""))
    given = pages.select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.col(url_col).alias("_url"),
        payload.alias("_payload"),
    ).withColumn("_key", F.unhex(F.sha2("_payload", 256)))
    shared = (
        given.groupBy("_key").agg(F.max("_id").alias("_first"), F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .select("_key", "_first")
    )
    revisits = (F.col("_id").isNull() | (F.col("_id") != F.col("_first"))) & (
        F.length("_payload") >= min_bytes
    )
    rows = given.join(shared, "_key", "left").select(
        "_id", "_url", "_payload", F.when(revisits, F.col("_first")).alias("_first")
    )
    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return settle(
        rows.mapInArrow(_write_archives(_whole_address(spark, folder)), "file string, records bigint"), "archives"
    )


FIELDS = (
    "file string, offset bigint, error string, record_type string, record_id string, "
    "refers_to string, target_uri string, payload_digest string, payload_bytes bigint, "
    "payload binary"
)


def _record_row(file: str, offset: int, record: Record) -> dict:
    headers, block = record
    head, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    digest = headers.get("warc-payload-digest", "").removeprefix(DIGEST_PREFIX)
    kind = headers["warc-type"]
    error = None
    if length is None:
        error = "no payload length"
    elif kind == "response":
        if int(length[1]) != len(payload):
            error = "payload length does not fit"
        elif payload_digest(payload) != digest:
            error = "payload digest does not fit"
    elif kind == "revisit" and (payload or "warc-refers-to" not in headers):
        error = "a revisit has a payload or refers to nothing"
    return {
        "file": file,
        "offset": offset,
        "error": error,
        "record_type": kind,
        "record_id": headers["warc-record-id"],
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "payload_digest": digest,
        "payload_bytes": int(length[1]) if length else None,
        "payload": payload if kind == "response" else None,
    }


def _reader(with_payload: bool, schema: pa.Schema):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content, listed in zip(*[batch.column(i) for i in range(3)]):
                name, rows, size, seen = file.as_py(), [], 0, 0
                try:
                    for offset, record in read_archive(content.as_py()):
                        seen += 1
                        row = _record_row(name, offset, record)
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        size += len(row["payload"] or b"")
                        if size > ARCHIVE_BYTES or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                    if listed.is_valid and listed.as_py() != seen:
                        rows.append({"file": name, "error": f"{seen} of {listed.as_py()} records"})
                except (WarcError, UnicodeDecodeError) as error:
                    rows.append({"file": name, "error": str(error)})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


def read_warc(
    spark: SparkSession, folder: str, archives: DataFrame | None = None, payloads: bool = True
) -> DataFrame:
    """One row per record of the archives in ``folder``.

    ``archives`` names the files that count and their records (as `write_warc`
    returns them). ``error`` is NULL for a record whose headers, lengths and
    payload digest hold; an archive that breaks off, holds another number of
    records than listed, or is not there gives one more row that says so.
    ``payloads=False`` leaves the payload NULL, the checks stay.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{SUFFIX}")
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )
    if archives is None:
        files = files.withColumn("records", F.lit(None).cast("bigint"))
    else:
        names = files.select("file")
        files = files.join(archives.select("file", "records"), "file")
    schema = pa.schema(
        [
            (name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[kind])
            for name, kind in (field.split(" ") for field in FIELDS.split(", "))
        ]
    )
    records = files.select("file", "content", "records").mapInArrow(_reader(payloads, schema), FIELDS)
    if archives is None:
        return records
    # Listings of a folder may lag behind, and archives may be lost.
    absent = archives.join(names, "file", "left_anti").select("file", F.lit("the archive is not there").alias("error"))
    return records.unionByName(absent, allowMissingColumns=True)


def id_from_record(name: str) -> Column:
    """The page id of a record id column, NULL where it has none."""
    return F.regexp_extract(name, r"page:(-?\d+)>$", 1).try_cast("bigint")


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared scratch folder."""
    return scratch_path(spark, "warc")

"""Many small rows for one bucket as one packed row, so that they shuffle compactly."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

SCHEMA = "bucket bigint, packed binary"


def pack(arrays: list[np.ndarray], level: int = 1) -> bytes:
    """Arrays, one after the other with their lengths, compressed."""
    parts = []
    for array in arrays:
        kind = array.dtype.str.encode()
        parts.append(struct.pack("<BQ", len(kind), array.nbytes) + kind)
        parts.append(np.ascontiguousarray(array).tobytes())
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(data):
        width, size = struct.unpack_from("<BQ", data, at)
        at += 9
        kind = np.dtype(data[at : at + width].decode())
        at += width
        out.append(np.frombuffer(data, dtype=kind, count=size // kind.itemsize, offset=at))
        at += size
    return out


def split_by(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``bucket, rows`` for every bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    begins = np.flatnonzero(np.concatenate([[True], sorted_bucket[1:] != sorted_bucket[:-1]]))
    for a, z in zip(begins, np.append(begins[1:], len(order))):
        if z > a:
            yield int(sorted_bucket[a]), order[a:z]


def to_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in rows], pa.int64()), pa.array([p for _, p in rows], pa.binary())],
        ["bucket", "packed"],
    )


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list[np.ndarray]]]]:
    """The unpacked rows of each bucket; rows have to come sorted by bucket."""
    bucket, held = None, []
    for batch in batches:
        for key, packed in zip(batch.column(0), batch.column(1)):
            if key.as_py() != bucket:
                if held:
                    yield bucket, held
                bucket, held = key.as_py(), []
            held.append(unpack(packed.as_py()))
    if held:
        yield bucket, held

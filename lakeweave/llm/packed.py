"""Columns of numbers packed into one binary value per shuffle bucket.

Operators that move tens of numbers per document send one row (bucket, payload) per task and bucket instead of one row
per number; Spark deals the rows out by bucket. Each column is byte-transposed and compressed.
"""

from __future__ import annotations

import io

import numpy as np
import zstandard
from pyspark.sql import SparkSession

_PACK = zstandard.ZstdCompressor(level=1)
_UNPACK = zstandard.ZstdDecompressor()


def pack(*columns: np.ndarray) -> bytes:
    """Columns of any equal or unequal lengths; a sorted unsigned column should be passed as differences."""
    out = io.BytesIO()
    for column in columns:
        column = np.ascontiguousarray(column)
        planes = np.ascontiguousarray(column.view(np.uint8).reshape(len(column), column.itemsize).T) if len(column) else column
        body = _PACK.compress(planes.tobytes())
        out.write(np.array([len(column), len(body)], np.int64).tobytes())
        out.write(column.dtype.str.encode().ljust(4))
        out.write(body)
    return out.getvalue()


def unpack(payload: bytes) -> list[np.ndarray]:
    view, at, out = memoryview(payload), 0, []
    while at < len(view):
        count, size = np.frombuffer(view[at:at + 16], np.int64)
        kind = np.dtype(bytes(view[at + 16:at + 20]).decode().strip())
        body = _UNPACK.decompress(view[at + 20:at + 20 + size])
        planes = np.frombuffer(body, np.uint8).reshape(kind.itemsize, count)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += 20 + int(size)
    return out


def joined(payloads: list[bytes]) -> list[np.ndarray]:
    """The columns of all payloads, end to end; the last one tells the payload of each row of the first column."""
    parts = [unpack(p) for p in payloads]
    out = [np.concatenate(columns) for columns in zip(*parts)]
    return [*out, np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])]


def bucket_count(spark: SparkSession, each: int = 4) -> int:
    """A few buckets per shuffle partition, so that payloads shrink as the job is given more partitions."""
    return each * max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))

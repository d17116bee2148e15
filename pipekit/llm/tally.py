"""Counting keys over all data and handing each asker the totals of its own keys.

A chunk asks with sorted distinct 64-bit keys, cut into buckets by their high bits. A bucket sums what all chunks say
of a key and answers each chunk with the totals (64 bits) in the order of its keys, so answers carry no keys. A key that fills
a third of the data costs a bucket one entry for each chunk. Buckets are of bounded size: their number grows with the
keys asked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

BUCKET_KEYS = 1 << 21
REQUEST = "chunk long, kind int, bucket int, keys binary, counts binary"
REPLY = "chunk long, kind int, bucket int, totals binary, distinct long"


def bucket_bits(keys: int) -> int:
    """Bits of a key that name its bucket, for so many keys in all (an upper bound will do)."""
    return max(4, (max(1, keys) // BUCKET_KEYS).bit_length())


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=dtype)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte by byte, so that the high bytes, mostly 0, take no room."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return packed(steps.view(np.uint8).reshape(-1, 8).T)


def unpacked_keys(data: bytes) -> np.ndarray:
    planes = unpacked(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


def packed_totals(values: np.ndarray) -> bytes:
    """64-bit totals byte by byte, so that the high bytes, mostly 0, take no room."""
    return packed(np.ascontiguousarray(values, dtype=np.int64).view(np.uint8).reshape(-1, 8).T)


def unpacked_totals(data: bytes, columns: int) -> np.ndarray:
    planes = unpacked(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64)[:, 0].reshape(-1, columns)


def requests(chunk: int, kind: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows of :data:`REQUEST` for sorted distinct ``keys`` (uint64) and their ``counts`` (rows of uint32 columns)."""
    bounds = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    some = [k for k in range(1 << bits) if bounds[k] < bounds[k + 1]]
    n = len(some)
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(some, pa.int32()),
         pa.array([packed_keys(keys[bounds[k]:bounds[k + 1]]) for k in some], pa.binary()),
         pa.array([packed(counts[bounds[k]:bounds[k + 1]]) for k in some], pa.binary())],
        names=["chunk", "kind", "bucket", "keys", "counts"])


def _answer(table: pa.Table) -> pa.Table:
    keys = [unpacked_keys(x) for x in table.column("keys").to_pylist()]
    sizes = np.array([len(k) for k in keys])
    counts = np.concatenate([unpacked(c, np.uint32).reshape(n, -1) for c, n in zip(
        table.column("counts").to_pylist(), sizes, strict=True)])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.stack([np.bincount(place, weights=counts[:, j], minlength=len(distinct)) for j in range(counts.shape[1])],
                    axis=1).astype(np.int64)
    answers = sums[place]
    cuts = np.cumsum(sizes)[:-1]
    return pa.table({"chunk": table.column("chunk"), "kind": table.column("kind"), "bucket": table.column("bucket"),
                     "totals": pa.array([packed_totals(a) for a in np.split(answers, cuts)], pa.binary()),
                     "distinct": pa.array([int((sums[:, 0] > 0).sum())] * table.num_rows, pa.int64())})


def tally(asked: DataFrame) -> DataFrame:
    """Answers (:data:`REPLY`) to rows of :data:`REQUEST`; distinct is the bucket's number of keys whose first count
    is not 0."""
    return asked.groupBy("kind", "bucket").applyInArrow(_answer, REPLY)


def totals_of(replies: pa.Table, kind: int, columns: int) -> np.ndarray:
    """Totals of one chunk's keys of a kind, in key order."""
    rows = sorted((b, t) for k, b, t in zip(replies.column("kind").to_pylist(), replies.column("bucket").to_pylist(),
                                            replies.column("totals").to_pylist(), strict=True) if k == kind)
    if not rows:
        return np.zeros((0, columns), dtype=np.int64)
    return np.concatenate([unpacked_totals(t, columns) for _, t in rows])

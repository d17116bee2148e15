"""Token ids of whole documents in files of coded blocks, and back.

Documents are laid out in ascending doc_id order (null ids first) over range partitions. A partition is a shard: its
ids form one stream, cut into blocks of ``range_coder.BLOCK`` ids that are coded on their own, with a checksum. A
shard is a Parquet part file with one row for each block:

    shard int, block int, n_tokens int, pieces binary, payload binary

``pieces`` lists the documents of the block, 17 bytes each, little-endian: place in the shard (u32), doc_id (i64),
1 if doc_id is null (u8), ids in this block (u32). A document that runs over blocks is listed in each of them. Parquet commits whole shards, so a
lost executor leaves no half-written one behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipekit.llm import range_coder, tokens
from pipekit.llm.common import offsets_by_part, spans, text_slices

PIECE = np.dtype([("place", "<u4"), ("doc_id", "<i8"), ("null", "u1"), ("n", "<u4")])
FILE_SCHEMA = "shard int, block int, n_tokens int, pieces binary, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str, vocab: int, end: int) -> None:
    """Encode doc_id and text of ``docs`` into files below ``path``. Null texts hold the end id alone; rows with one
    doc_id stay rows of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, place = TaskContext.get().partitionId(), 0, 0
        ids, pieces = np.zeros(0, dtype=np.uint32), []

        def coded(stream: np.ndarray, pieces: list) -> pa.RecordBatch:
            nonlocal block
            blocks = [stream[k:k + range_coder.BLOCK] for k in range(0, len(stream), range_coder.BLOCK)]
            listed = np.array(pieces, dtype=PIECE)
            # Cut the pieces where blocks end.
            ends = np.cumsum(listed["n"], dtype=np.int64)
            edges = np.arange(1, len(blocks)) * range_coder.BLOCK
            cuts = np.union1d(ends, edges)
            of = np.searchsorted(ends, cuts)
            split = listed[of]
            split["n"] = np.diff(cuts, prepend=0)
            bounds = np.searchsorted(cuts, np.arange(1, len(blocks) + 1) * range_coder.BLOCK, "right")
            bounds[-1] = len(split)
            parts = [split[a:b].tobytes() for a, b in zip([0, *bounds[:-1]], bounds, strict=True)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(blocks), shard, dtype=np.int32)),
                 pa.array(np.arange(block, block + len(blocks), dtype=np.int32)),
                 pa.array(np.array([len(b) for b in blocks], dtype=np.int32)), pa.array(parts, pa.binary()),
                 pa.array(range_coder.encode_blocks(blocks, vocab), pa.binary())],
                names=["shard", "block", "n_tokens", "pieces", "payload"])
            block += len(blocks)
            return out

        most = range_coder.BLOCK * range_coder.LANES
        for batch in text_slices(batches):
            got, counts = tokens.encode(batch.column("text"), tokenizer, end)
            ids = np.concatenate([ids, got])
            for doc_id, n in zip(batch.column("doc_id").to_pylist(), counts, strict=True):
                pieces.append((place, doc_id or 0, doc_id is None, n))
                place += 1
            while len(ids) >= most:
                listed = np.array(pieces, dtype=PIECE)
                ends = np.cumsum(listed["n"], dtype=np.int64)
                k = int(np.searchsorted(ends, most))  # the document that holds the last id of this round
                taken, rest = pieces[:k + 1], pieces[k:]
                taken[-1] = (*pieces[k][:3], pieces[k][3] - int(ends[k] - most))
                rest[0] = (*pieces[k][:3], int(ends[k] - most))
                rest = rest if rest[0][3] else rest[1:]
                yield coded(ids[:most], taken)
                ids, pieces = ids[most:], rest
        if len(ids):
            yield coded(ids, pieces)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The text's hash spreads rows that share a doc_id; those may stand in any order.
    ranged = texts.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def _crc_powers() -> np.ndarray:
    """Matrices that move a CRC over 1, 2, 4 ... zero bytes; row b is the image of bit b."""
    def squared(m: np.ndarray) -> np.ndarray:
        return np.array([_apply(m, int(x)) for x in m], dtype=np.uint64)
    bit = np.array([0xEDB88320] + [1 << k for k in range(31)], dtype=np.uint64)
    byte = squared(squared(squared(bit)))
    out = [byte]
    for _ in range(40):
        out.append(squared(out[-1]))
    return np.stack(out)


def _apply(matrix: np.ndarray, crc: int) -> int:
    out, k = 0, 0
    while crc:
        if crc & 1:
            out ^= int(matrix[k])
        crc >>= 1
        k += 1
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of byte strings one after another, from the (length, CRC-32) of each."""
    out = 0
    for length, crc in parts:
        k = 0
        while length and out:
            if length & 1:
                out = _apply(_POWERS[k], out)
            length >>= 1
            k += 1
        out ^= crc
    return out


_POWERS = _crc_powers()


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """shard, place, doc_id, start (in the shard), n, crc of every piece, decoded from the files; ``with_ids``
    adds the ids themselves (array<int>)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, range_coder.LANES):
                batch = whole.slice(first, range_coder.LANES)
                decoded = range_coder.decode_blocks(batch.column("payload").to_pylist())
                listed = [np.frombuffer(p, dtype=PIECE) for p in batch.column("pieces").to_pylist()]
                crcs, lists = [], []
                for ids, pieces in zip(decoded, listed, strict=True):
                    at = spans(pieces["n"])
                    if at[-1] != len(ids):
                        raise ValueError("pieces and ids of a block differ")
                    raw = ids.astype("<u4").tobytes()
                    crcs += [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                    lists += [ids[a:b].astype(np.int32) for a, b in zip(at[:-1], at[1:], strict=True)] if with_ids else []
                each = np.array([len(p) for p in listed])
                p = np.concatenate(listed)
                block = np.repeat(batch.column("block").to_numpy().astype(np.int64), each)
                inside = np.concatenate([spans(x["n"])[:-1] for x in listed])
                columns = [pa.array(np.repeat(batch.column("shard").to_numpy(), each)),
                           pa.array(p["place"].astype(np.int64)),
                           pa.array(p["doc_id"].astype(np.int64), mask=p["null"] == 1),
                           pa.array(block * range_coder.BLOCK + inside), pa.array(p["n"].astype(np.int64)),
                           pa.array(np.array(crcs, dtype=np.int64))]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "shard int, place long, doc_id long, start long, n long, crc long"
    schema += ", ids array<int>" if with_ids else ""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return spark.read.schema(FILE_SCHEMA).parquet(path).select("shard", "block", "pieces", "payload").mapInArrow(run, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, all from decoded ids."""
    starts = offsets_by_part(spark.read.schema(FILE_SCHEMA).parquet(path), "shard", "n_tokens")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            crcs = [joined_crc([(4 * p["n"], p["crc"]) for p in r["parts"]]) for r in rows]
            begin = [starts[r["shard"]] + r["start"] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(begin, pa.int64()), b.column("n_tokens"), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    whole = read_pieces(spark, path).groupBy("shard", "place").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("parts"))
    return whole.select("shard", "doc_id", "start", "n_tokens", "parts").mapInArrow(
        join, "doc_id long, start long, n_tokens long, ids_crc32 long")

"""Small helpers the operators share: Arrow text slices, word hashes, numbering, components."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipekit.session import durable

SLICE_BYTES = 6 << 20
U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, if that folder is there for them too."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, held]))


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished queries stay until the driver collects its garbage; large ones should not wait."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_heaps(spark: SparkSession) -> None:
    """Executors give unused heap back: one task for each core asks its JVM to collect. A heap that grew in one step
    else stays as large beside the Python workers of the next."""
    cores = spark.sparkContext.defaultParallelism
    collect = F.java_method(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, cores, 1, cores).select(collect.alias("done")).write.format("noop").mode("overwrite").save()


def fold(doc_id, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fold_of(doc_id, folds: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to some megabytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(lengths, dtype=np.int64) // most
        edges = np.flatnonzero(np.diff(cut)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch as dicts, one at a time: a row that holds a slice of texts is megabytes."""
    for k in range(batch.num_rows):
        yield from batch.slice(k, 1).to_pylist()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, whose worker gives free memory back at its end: idle workers live on beside the steps
    that follow."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
                trim(0)
    return task


def filled(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "")


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words between ASCII white space, A-Z lower-cased if ``lower``: (distinct words, code of each word, words per
    text)."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(filled(texts)) if lower else filled(texts))
    offsets = parts.offsets.to_numpy()
    flat = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
    keep = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False), dtype=np.int64)])
    counts = np.diff(before[offsets - offsets[0]])
    coded = flat.filter(keep).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), counts


def hash_words(words: pa.Array) -> np.ndarray:
    import xxhash
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], dtype=U64)


def spans(counts: np.ndarray) -> np.ndarray:
    """Start offsets of groups with these sizes, with the end as the last entry."""
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp): the smallest node reachable over undirected ``edges`` (a, b); nodes without an edge are absent.

    Alternating large and small stars: every round re-hangs neighbours on the smallest one, in a number of rounds
    that grows with the logarithm of the component size. Groups are only aggregated and joined, never gathered.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            least = e.groupBy("a").agg(F.min("b").alias("m"))
            moved = e.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return moved.where("a != b").distinct()

    e = durable(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                name)
    seen = None
    while True:
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        e = durable(stars(stars(e, True), False), name)
    return e.groupBy("a").agg(F.min("b").alias("comp")).select(F.col("a").alias("node"), "comp").union(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def offsets_by_part(df: DataFrame, part: str, size: str) -> dict[int, int]:
    """Running start of each partition: one number per partition reaches the driver, whatever the rows."""
    sums = {r[0]: r[1] for r in df.groupBy(part).agg(F.sum(size)).collect()}
    out, at = {}, 0
    for p in sorted(sums):
        out[p] = at
        at += sums[p]
    return out

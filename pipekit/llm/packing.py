"""Best-fit packing of token pieces by a grouping genetic algorithm, distributed as islands with elite migration.

Pieces are dealt at random into shards of about ``SHARD`` pieces. On each shard several islands evolve packings of
their own. A crossover takes whole well-filled bins of one parent into the other, drops the bins that hold the same
pieces, and puts the displaced pieces back by best fit, longest first. Between epochs the best packing of each island
moves to the next island of the shard. Bins that stay under-filled are dealt out again over fewer shards, so that the
shards' remainders share sequences.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pipekit.llm import tokens
from pipekit.llm.common import text_slices
from pipekit.session import durable

CAPACITY = 4096
SHARD = 4096
ISLANDS = 2
POPULATION = 4
GENERATIONS = 12
EPOCHS = 2
WELL_FILLED = 0.98

Bins = list[list[int]]


def best_fit(items: list[int], size: list[int], capacity: int, bins: Bins) -> Bins:
    """Put ``items`` in order into the fullest bin that still has room; ``bins`` grows in place."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for k, members in enumerate(bins):
        free = capacity - sum(size[i] for i in members)
        room[free].append(k)
        mask |= 1 << free
    for item in items:
        need = size[item]
        fits = mask >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            k = room[free].pop()
            if not room[free]:
                mask &= ~(1 << free)
            bins[k].append(item)
        else:
            free, k = capacity, len(bins)
            bins.append([item])
        room[free - need].append(k)
        mask |= 1 << (free - need)
    return bins


def fitness(bins: Bins, size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins as unevenly filled as can be."""
    return -len(bins), sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(mother: Bins, father: Bins, size: list[int], capacity: int, rng: random.Random) -> Bins:
    loads = [sum(size[i] for i in b) for b in father]
    filled = [k for k, load in enumerate(loads) if load >= WELL_FILLED * capacity]
    taken = rng.sample(filled, len(filled) // 2) if filled else []
    inside = {i for k in taken for i in father[k]}
    child: Bins = [list(father[k]) for k in taken]
    displaced = []
    for b in mother:
        if inside.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in inside]
    # Some poorly filled bins are opened too: only they can make room for fewer bins.
    keep: Bins = []
    for b in child:
        if sum(size[i] for i in b) < WELL_FILLED * capacity and rng.random() < 0.5:
            displaced += b
        else:
            keep.append(b)
    displaced.sort(key=lambda i: -size[i])
    return best_fit(displaced, size, capacity, keep)


def evolve(size: list[int], capacity: int, seed: int, guests: list[Bins]) -> Bins:
    """One epoch on one island: the best packing found. ``guests`` join the first population."""
    rng = random.Random(seed)
    order = sorted(range(len(size)), key=lambda i: -size[i])
    least = -(-sum(size) // capacity)
    people = [*guests, best_fit(order, size, capacity, [])]
    while len(people) < POPULATION:
        # Nearly descending orders: best fit then leaves other combinations open.
        loose = sorted(order, key=lambda i: -size[i] * rng.uniform(0.7, 1))
        people.append(best_fit(loose, size, capacity, []))
    people.sort(key=lambda b: fitness(b, size, capacity), reverse=True)
    for _ in range(GENERATIONS):
        if len(people[0]) <= least:
            break
        mother, father = rng.sample(people[:POPULATION], 2)
        people.append(crossover(mother, father, size, capacity, rng))
        people.sort(key=lambda b: fitness(b, size, capacity), reverse=True)
        people = people[:POPULATION]
    return people[0]


def _island(capacity: int, epoch: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(rows["shard"].iloc[0]), int(rows["island"].iloc[0])
        own = rows[rows["guest"] == 0].sort_values("uid")
        uids, size = own["uid"].to_numpy(), own["n"].tolist()
        guests = []
        for _, packed in rows[rows["bin"] >= 0].groupby("guest"):
            packed = packed.sort_values("uid")
            bins: Bins = [[] for _ in range(int(packed["bin"].max()) + 1)]
            for i, b in enumerate(packed["bin"]):
                bins[b].append(i)
            guests.append(bins)
        best = evolve(size, capacity, zlib.crc32(f"{shard} {island} {epoch}".encode()), guests)
        at = [i for b in best for i in b]
        offsets, of = [], []
        for k, b in enumerate(best):
            begin = 0
            for i in b:
                offsets.append(begin)
                of.append(k)
                begin += size[i]
        _, spread = fitness(best, size, capacity)
        return pd.DataFrame({"shard": shard, "island": island, "uid": uids[at], "n": [size[i] for i in at], "bin": of,
                             "place": offsets, "bins": len(best), "spread": spread})
    return run


PACKED = "shard long, island int, uid long, n long, bin int, place long, bins long, spread double"


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_size: int = SHARD) -> DataFrame:
    """uid, sequence_id, place for ``pieces`` (uid long and unique, n long from 1 to ``capacity``)."""
    pieces = pieces.select("uid", "n")
    done, level = None, 0
    while True:
        count = pieces.count()
        shards = max(1, -(-count // shard_size))
        dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards))).withColumn(
            "island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
        start = dealt.withColumn("guest", F.lit(0)).withColumn("bin", F.lit(-1))
        for epoch in range(EPOCHS):
            best = durable(start.groupBy("shard", "island").applyInPandas(_island(capacity, epoch), PACKED), "pack-epoch")
            own = best.select("shard", "island", "uid", "n", F.lit(0).alias("guest"), "bin")
            moved = own.withColumn("island", (F.col("island") + 1) % ISLANDS).withColumn("guest", F.lit(1))
            start = own.union(moved)
        order = Window.partitionBy("shard").orderBy("bins", F.desc("spread"), "island")
        heads = best.select("shard", "island", "bins", "spread").distinct().withColumn(
            "r", F.row_number().over(order)).where("r = 1").select("shard", "island")
        best = best.join(heads, ["shard", "island"], "left_semi")
        fill = best.groupBy("shard", "bin").agg(F.sum("n").alias("load"))
        marked = durable(best.join(fill, ["shard", "bin"]).withColumn(
            "sequence_id", (F.lit(level) * F.lit(1 << 56)) + F.col("shard") * F.lit(1 << 16) + F.col("bin")), "pack-level")
        loose = marked.where(F.col("load") < WELL_FILLED * capacity)
        last = shards == 1
        fixed = marked if last else marked.where(F.col("load") >= WELL_FILLED * capacity)
        fixed = fixed.select("uid", "sequence_id", "place")
        done = fixed if done is None else done.union(fixed)
        if last:
            return done
        # Under-filled bins: about one for each shard, so every round leaves far fewer pieces. Should most pieces be
        # loose (pieces that do not combine), another deal over fewer shards cannot help and the packing stands.
        total, left = marked.agg(F.count("*"), F.count(F.when(F.col("load") < WELL_FILLED * capacity, 1))).first()
        if not left or left * 2 > total:
            return done.union(loose.select("uid", "sequence_id", "place"))
        pieces, level = loose.select("uid", "n"), level + 1


def cut_documents(docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY,
                  with_ids: bool = False) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32 of every piece; ``with_ids`` adds the ids (array<int>).

    Only documents of more than ``capacity`` ids are cut. Null texts hold the end id alone. A row is a document, also
    where rows share a doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        for batch in text_slices(batches):
            ids, counts = tokens.encode(batch.column("text"), tokenizer, end)
            each = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), each)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
            start = piece * capacity
            length = np.minimum(capacity, counts[doc] - start)
            begin = np.repeat(np.cumsum(counts) - counts, each) + start
            raw = memoryview(ids.astype("<u4").tobytes())
            crcs = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            columns = [pa.array(np.arange(uid, uid + len(doc))), batch.column("doc_id").take(pa.array(doc)),
                       pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)),
                       pa.array(length.astype(np.int64)), pa.array(crcs, pa.int64())]
            if with_ids:
                columns.append(pa.array([ids[a:a + n].astype(np.int32) for a, n in zip(begin, length, strict=True)],
                                        pa.list_(pa.int32())))
            uid += len(doc)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` with sequence_id and offset: no sequence holds more than ``capacity`` ids, and its pieces
    lie without gaps from 0. An empty table gives an empty result."""
    pieces = durable(cut_documents(docs, tokenizer, end, capacity, with_ids), "pack-pieces")
    placed = pack_pieces(pieces.select("uid", F.col("length").alias("n")), capacity)
    return pieces.join(placed, "uid").withColumnRenamed("place", "offset").drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids (array<int>) from :func:`pack_documents` with ids; a sequence is of bounded size."""
    laid = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return laid.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))

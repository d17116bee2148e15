"""MinHash near-dedup by fast similarity sketching (Dahlgaard, Knudsen and Thorup, 2017).

Round i of the sketch throws every shingle into a hashed bin with the value (i, hash); a bin keeps its smallest
value, so later rounds only fill bins that are still empty. After t hashed rounds, round t + j throws everything into
bin j, which guarantees a full sketch. Bands of the sketch give candidates, whole shingle sets confirm them.

Equal shingle sets form one class before banding, so thousands of copies are one node. In a bucket every member is
first compared with the bucket's pivot. Buckets whose members then still lie in several components are
compared further, across components only, and only where sizes, distances to the pivot and shingles that nobody else
holds leave room for a link: these bounds are exact, and no pair inside a known component is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipekit.llm.common import U64, components, filled, free_heaps, free_shuffles, hash_words, lean, mix, one_by_one, spans, split_words, text_slices
from pipekit.llm.tally import REQUEST, bucket_bits, packed, requests, tally, totals_of, unpacked
from pipekit.session import durable

SHINGLE = 5
BINS = 128
BAND_ROWS = 4
MAP_WORDS = 64
EMPTY = U64(0xFFFFFFFFFFFFFFFF)


def _odd(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, one text after another, and how many each has. A text with fewer words
    than ``width`` is one shingle."""
    at, factors = spans(counts), _odd(7, width)
    with np.errstate(over="ignore"):
        weighted = np.zeros(max(0, len(hashes) - width + 1), dtype=U64)
        for j in range(width):
            weighted += hashes[j:len(weighted) + j] * factors[j]
        weighted = mix(weighted)
        out = []
        for k, n in enumerate(counts):
            if n >= width:
                out.append(np.unique(weighted[at[k]:at[k + 1] - width + 1]))
            elif n:
                whole = (hashes[at[k]:at[k + 1]] * factors[:n]).sum(dtype=U64) + U64(n)
                out.append(mix(np.array([whole], dtype=U64)))
            else:
                out.append(np.zeros(0, dtype=U64))
    sizes = np.array([len(x) for x in out], dtype=np.int64)
    return (np.concatenate(out) if out else np.zeros(0, dtype=U64)), sizes


def sketch(values: np.ndarray, sizes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values for each set; an empty set keeps EMPTY everywhere."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    table = np.full((len(sizes), bins), EMPTY, dtype=U64)
    flat, live = table.reshape(-1), values
    for i in range(2 * bins):
        if not len(live):
            break
        with np.errstate(over="ignore"):
            h = mix(live + U64(i + 1) * U64(0xD1B54A32D192ED03))
        bin_ = (h % U64(bins)).astype(np.int64) if i < bins else np.full(len(h), i - bins)
        np.minimum.at(flat, rows * bins + bin_, (U64(i) << U64(55)) | (h >> U64(9)))
        short = (table == EMPTY).any(axis=1)[rows]
        rows, live = rows[short], live[short]
    return table


def set_prints(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """16 bytes that name a set: two independent sums over its members."""
    if not len(values):
        return [b""] * len(sizes)
    at = np.minimum(spans(sizes)[:-1], len(values) - 1)
    with np.errstate(over="ignore"):
        a = np.add.reduceat(mix(values + U64(11)), at)
        b = np.add.reduceat(mix(values ^ U64(0x5851F42D4C957F2D)), at)
    both = np.stack([a, b], axis=1).astype(">u8")
    return [both[k].tobytes() if n else b"" for k, n in enumerate(sizes)]


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    words, codes, counts = split_words(texts)
    return shingle_hashes(hash_words(words)[codes], counts, width)


def _signatures(width: int):
    """Each slice of documents as one row: ids, set sizes, set prints, band keys, and the texts for a second look."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches):
            values, sizes = _sets(batch.column("text"), width)
            table = sketch(values, sizes)
            bands = table.reshape(len(sizes), -1, BAND_ROWS)
            with np.errstate(over="ignore"):
                keys = mix((bands * _odd(23, BAND_ROWS)).sum(axis=2, dtype=U64)
                           + np.arange(bands.shape[1], dtype=U64) * U64(0x9E3779B97F4A7C15))
            texts = filled(batch.column("text")).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([sizes.tolist()], pa.list_(pa.int64())),
                 pa.array([set_prints(values, sizes)], pa.list_(pa.binary())), pa.array([packed(keys)], pa.binary()),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                 pa.array([packed(np.frombuffer(b"".join(texts), dtype=np.uint8))], pa.binary())],
                names=["chunk", "doc_ids", "sizes", "nodes", "bands", "lengths", "texts"])
            chunk += 1
    return run


SIGNED = ("chunk long, doc_ids array<long>, sizes array<long>, nodes array<binary>, bands binary, lengths array<long>, "
          "texts binary")


def _band_keys(row: dict) -> np.ndarray:
    """Band keys of the chunk's documents with words, a row each."""
    return unpacked(row["bands"], U64).reshape(len(row["sizes"]), -1)[np.array(row["sizes"], dtype=np.int64) > 0]


def _ask_bands(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                keys, counts = np.unique(_band_keys(row), return_counts=True)
                if len(keys):
                    yield requests(row["chunk"], 0, keys, counts.astype(np.uint32)[:, None], bits)
    return run


def _shared_bands(_, left: pa.Table, right: pa.Table) -> pa.Table:
    """Bands that documents of a chunk share with any other row."""
    out = []
    for row in left.to_pylist():
        bands = _band_keys(row)
        keys = np.unique(bands)
        some = np.flatnonzero(np.array(row["sizes"]) > 0)
        if len(keys):
            doc, band = np.nonzero(totals_of(right, 0, 1)[:, 0][np.searchsorted(keys, bands)] > 1)
            out.append(pa.table({"chunk": np.full(len(doc), row["chunk"]), "place": some[doc],
                                 "node": pa.array([row["nodes"][k] for k in some[doc]], pa.binary()),
                                 "band": bands[doc, band].view(np.int64)}))
    return pa.concat_tables(out) if out else pa.table({
        "chunk": pa.array([], pa.int64()), "place": pa.array([], pa.int64()), "node": pa.array([], pa.binary()),
        "band": pa.array([], pa.int64())})


def _shingle_sets(width: int):
    """Sets of the documents at ``places`` of each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                at, data = spans(np.array(row["lengths"])), unpacked(row["texts"], np.uint8).tobytes()
                texts = pa.array([data[at[k]:at[k + 1]] for k in row["places"]], pa.binary()).cast(pa.string())
                values, sizes = _sets(texts, width)
                lists = pa.ListArray.from_arrays(spans(sizes).astype(np.int32), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([row["nodes"][k] for k in row["places"]], pa.binary()), lists],
                                                 names=["node", "shingles"])
    return run


def _bit_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set: the places its shingles hash to, 64 to a column, and how many shingles it has beyond its places."""
    for batch in batches:
        lists = batch.column("shingles")
        values = mix(lists.flatten().to_numpy().view(U64) + U64(41))
        row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        filled_ = np.zeros((batch.num_rows, MAP_WORDS * 64), dtype=bool)
        filled_[row, (values % U64(MAP_WORDS * 64)).astype(np.int64)] = True
        maps = np.packbits(filled_, axis=1, bitorder="little").view("<i8")
        more = np.diff(lists.offsets.to_numpy()) - filled_.sum(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(more), *[pa.array(m) for m in maps.T.copy()]],
                                         names=["node", "more", *[f"m{k}" for k in range(MAP_WORDS)]])


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text; other columns are ignored).

    Rows link when 100 * intersection >= ``percent`` * union of their shingle sets. Null, empty or blank texts have an
    empty set and link with nothing. A null doc_id is never a representative while its component holds another id;
    rows that share a doc_id are rows of their own. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = durable(texts.mapInArrow(lean(_signatures(width)), SIGNED), "near-chunks")
    rows = F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("sizes").alias("n"), F.col("nodes").alias("node"))
    signed = chunks.select(F.explode(rows).alias("d")).select("d.doc_id", F.col("d.n").alias("n_shingles"), "d.node")
    nodes = durable(signed.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")), "near-nodes")
    # Which bands occur twice at all: keys alone move for that.
    count = chunks.select(F.sum(F.size("sizes"))).first()[0] or 0
    asked = chunks.select("chunk", "sizes", "bands").mapInArrow(
        lean(_ask_bands(bucket_bits(count * BINS // BAND_ROWS))), REQUEST)
    shared = durable(chunks.select("chunk", "sizes", "nodes", "bands").groupBy("chunk").cogroup(
        tally(asked).groupBy("chunk")).applyInArrow(_shared_bands, "chunk long, place long, node binary, band long"),
        "near-shared")
    banded = durable(shared.select("node", "band").distinct(), "near-bands")
    free_shuffles(docs.sparkSession)
    # One order for all bands: a group of near copies meets few pivots, whichever bands its members share.
    drawn = banded.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    members = durable(banded.join(drawn, "band").select("band", "node", "pivot"), "near-members")
    # One document delivers the set of each candidate.
    chosen = shared.groupBy("node").agg(F.min(F.struct("chunk", "place")).alias("at")).join(
        members.select("node").distinct(), "node", "left_semi")
    places = chosen.groupBy("at.chunk").agg(F.collect_set("at.place").alias("places"))  # as many as a chunk has documents
    sets = durable(chunks.select("chunk", "nodes", "lengths", "texts").join(places, "chunk").mapInArrow(
        lean(_shingle_sets(width)), "node binary, shingles array<long>"), "near-sets")

    def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """a, b, dist (Jaccard distance) and linked of each pair whose sizes do not rule a link out."""
        left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
        both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        sizes = [nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}")) for c in "ab"]
        both = both.join(sizes[0], "a").join(sizes[1], "b").where(
            F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        both = both.select("a", "b", "na", "nb").join(left, "a").join(right, "b").withColumn(
            "common", F.size(F.array_intersect("sa", "sb"))).withColumn("union", F.col("na") + F.col("nb") - F.col("common"))
        return durable(both.select("a", "b", (1 - F.col("common") / F.col("union")).alias("dist"), (
            F.col("common") * 100 >= F.col("union") * percent).alias("linked")), "near-measured")

    # Each node meets one pivot, the least of its bands: most groups are whole after that. Then it meets the pivots of its
    # other bands, where the two are still apart.
    apart = members.where("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    met = measured(apart.groupBy("a").agg(F.min("b").alias("b")), sets)
    links = met.where("linked").select("a", "b")
    comps = durable(components(links, "near-comps"), "near-comp")
    free_shuffles(docs.sparkSession)
    free_heaps(docs.sparkSession)
    sides = [comps.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")) for c in "ab"]
    open_pairs = apart.join(sides[0], "a", "left").join(sides[1], "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = measured(open_pairs.distinct().join(met, ["a", "b"], "left_anti"), sets)
    links = links.union(more.where("linked").select("a", "b"))
    comps = durable(components(links, "near-comps"), "near-comp")
    # The pivot has met every member of its bucket, or is linked with it. What is left are the others, across components.
    labelled = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = labelled.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    known = met.union(more).select("a", "b", "dist")
    rest = labelled.where("node != pivot").join(split.select("band"), "band", "left_semi").join(
        known, (F.least("node", "pivot") == F.col("a")) & (F.greatest("node", "pivot") == F.col("b")), "left")
    rest = durable(rest.select("band", "node", "dist", "comp"), "near-rest")
    open_sets = durable(sets.join(rest.select("node").distinct(), "node", "left_semi"), "near-open-sets")
    # A shingle that no other open set holds is in no intersection: few pairs can still reach the similarity.
    held = open_sets.select(F.xxhash64("node").alias("id"), F.explode("shingles").alias("s"))
    own = held.groupBy("s").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1").groupBy("id").agg(
        F.count("*").alias("own"))
    sized = rest.join(nodes.select("node", "n"), "node").join(own, F.xxhash64("node") == F.col("id"), "left").withColumn(
        "most", F.col("n") - F.coalesce("own", F.lit(0))).where(F.col("most") * 100 >= F.col("n") * percent)
    maps = open_sets.mapInArrow(_bit_maps, "node binary, more long, " + ", ".join(f"m{k} long" for k in range(MAP_WORDS)))
    bits = [f"m{k}" for k in range(MAP_WORDS)]
    held = ["node", "dist", "comp", "n", "most", "more", *bits]
    # All open bands of a node, 2 * BINS / BAND_ROWS at most: a pair is taken up in the first band it shares.
    every = sized.groupBy("node").agg(F.collect_set("band").alias("bands"))
    held = [*held, "bands"]
    sized = durable(sized.join(maps, "node").join(every, "node").select("band", *held), "near-sized")
    x, y = (sized.select("band", *[F.col(c).alias(c + k) for c in held]) for k in "xy")
    # Jaccard distance is a metric: rows whose distances to the pivot differ by more than a link cannot link.
    reach = 1 - percent / 100 + 1e-9
    common = F.least("mostx", "mosty")
    # Places of a bit map that both fill, and what either has beyond one for each place, bound the intersection too.
    places = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"{c}x").bitwiseAND(F.col(f"{c}y"))) for c in bits])
    tight = places + F.least("morex", "morey")
    near = (F.col("distx").isNull() | F.col("disty").isNull() | (F.abs(F.col("distx") - F.col("disty")) <= reach)) & (
        common * 100 >= (F.col("nx") + F.col("ny") - common) * percent) & (
        tight * 100 >= (F.col("nx") + F.col("ny") - tight) * percent)
    first = F.array_min(F.array_intersect("bandsx", "bandsy")) == F.col("band")
    met = measured(x.join(y, "band").where((F.col("compx") < F.col("compy")) & near & first).select(
        F.col("nodex").alias("a"), F.col("nodey").alias("b")), open_sets)
    links = links.union(met.where("linked").select("a", "b"))
    comps = durable(components(links, "near-comps"), "near-comp")
    named = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    classes = named.join(least, "comp").select("node", "component_id")
    out = signed.select("doc_id", "n_shingles", "node").join(classes, "node", "left")
    return out.select("doc_id", "n_shingles",
                      F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                      .alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id (a null one last), then the first in order;
    rows without words stay. Rows count one by one, also where they share a doc_id or have none."""
    # Groups are made over row numbers: each row is a node of its own, and one without words a group of its own.
    numbered = durable(docs.withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    groups = near_duplicates(numbered.select(F.col("__row").alias("doc_id"), "text"), **options).select(
        F.col("doc_id").alias("__row"), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    chosen = numbered.select("__row", "doc_id").join(groups, "__row").groupBy("component_id").agg(
        F.min(rank).alias("first")).select("first.__row")
    return numbered.join(chosen, "__row", "left_semi").select(*docs.columns)

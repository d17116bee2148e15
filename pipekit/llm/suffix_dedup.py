"""Removing passages that repeat anywhere in the corpus, found over a suffix array.

A byte goes if it lies in a string of ``length`` bytes (``LENGTH`` unless the caller says so) that also starts
elsewhere. A suffix array over every byte of the corpus is not needed for that. Anchors are chosen by content: of the
:func:`gram_of`-byte strings in each window of ``length`` bytes, the one with the smallest hash. Equal windows have equal
anchors in equal places, so

1. anchors whose string occurs once cannot lie in a repeated window and cut the text into runs (:mod:`tally`);
2. each run is a string of phrases, from one anchor to the next, named by hash; :mod:`suffix_array` sorts all their
   suffixes by the difference-cover algorithm;
3. adjacent suffixes are compared: where both have the same phrase and the same length - 1 bytes after it, every
   window that starts in the phrase is repeated;
4. what is left are windows at the ends of repeats, whose phrases differ to the left or right. Those of them whose
   anchor is shared with any other unsettled window are settled one by one, by counting equal windows.

Steps 1, 3 and 4 compare 64-bit hashes of the bytes. Texts stay whole and no step gathers a group of copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from pipekit.llm import tally
from pipekit.llm.common import U64, filled, free_heaps, free_shuffles, lean, mix, one_by_one, spans, text_slices
from pipekit.llm.suffix_array import suffix_ranks
from pipekit.session import durable, scratch, working_tables

LENGTH = 400
GRAM = 128
SEGMENT = (1 << 17) - 4096  # hashes of a segment fit a core's cache; no result depends on it
MARGIN = 2048
FACTOR = 0x9E3779B97F4A7C15 | 1
ANCHOR, OPEN, WINDOW = 0, 1, 2
STRIDE_BITS = 26
CHUNK_BYTES = 3 << 20


def gram_of(length: int) -> int:
    """Bytes of an anchor string for windows of ``length`` bytes; no result but n_shared depends on it."""
    if not 8 <= length <= MARGIN // 2:
        raise ValueError(f"windows have 8 to {MARGIN // 2} bytes, not {length}")
    return length * GRAM // LENGTH


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = SEGMENT + MARGIN + 1
    inverse = pow(FACTOR, -1, 1 << 64)
    with np.errstate(over="ignore"):
        powers, back = (np.cumprod(np.where(np.arange(n) > 0, U64(f), U64(1))) for f in (FACTOR, inverse))
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93)), powers, back


BYTES, POWERS, BACK = _tables()


class Rolling:
    """Hashes of substrings of a piece of at most SEGMENT + MARGIN bytes."""

    def __init__(self, piece: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(piece) + 1, dtype=U64)
            np.cumsum(BYTES.take(piece) * POWERS[:len(piece)], dtype=U64, out=self.sums[1:])

    def of(self, start, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[start + length] - self.sums[start]) * BACK[start] + np.asarray(length).astype(U64))

    def all_of(self, length: int) -> np.ndarray:
        """Of every start, in place of an index array."""
        with np.errstate(over="ignore"):
            return mix((self.sums[length:] - self.sums[:-length]) * BACK[:len(self.sums) - length] + U64(length))


def pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(data), SEGMENT):
        yield start, data[start:start + SEGMENT + MARGIN]


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """For each segment, rows of: anchors, first window of each inside one text, number of its windows, which follow each
    other, and (bits of) the hash of the anchor string."""
    gram = gram_of(length)
    width, place = length - gram + 1, U64(0xFFFFF)
    for start, piece in pieces(data):
        if len(piece) < length:
            continue
        grams = Rolling(piece).all_of(gram)
        key = grams & ~place
        key |= np.arange(len(grams), dtype=U64)  # the leftmost of equal ones
        span = 1
        while 2 * span <= width:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < width:
            key = np.minimum(key[:len(key) - (width - span)], key[width - span:])
        anchor = key[:SEGMENT] & place
        for end in (ends[slice(*np.searchsorted(ends, [start + 1, start + len(anchor) + length]))] - start).tolist():
            anchor[max(0, end - length + 1):end] = place  # these windows run past the end of a text
        cut = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
        many = np.diff(np.append(cut, len(anchor)))
        inside = anchor[cut] != place
        cut, many = cut[inside], many[inside]
        at = anchor[cut].astype(np.int64)
        yield np.stack([at + start, cut + start, many, grams[at].view(np.int64)])


def anchors_with_grams(data: np.ndarray, ends: np.ndarray,
                       length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, first window of each, number of its windows, which follow each other, hash of the anchor string)."""
    anchor, start, many, gram = np.concatenate([np.zeros((4, 0), dtype=np.int64), *anchor_runs(data, ends, length)], axis=1)
    # An anchor at the edge of a segment has windows in both.
    inner, first, of = np.unique(anchor, return_index=True, return_inverse=True)
    return (inner, start[first], np.bincount(of, weights=many, minlength=len(inner)).astype(np.int64),
            np.ascontiguousarray(gram[first]).view(U64))


def anchor_windows(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, first window of each, number of its windows, which follow each other)."""
    return anchors_with_grams(data, ends)[:3]


def range_hashes(data: np.ndarray, starts: np.ndarray, *lengths: np.ndarray) -> np.ndarray:
    """Hashes of the strings that begin at ascending ``starts``: a row for each array of lengths, one row by itself."""
    out = np.zeros((len(lengths), len(starts)), dtype=U64)
    for start, piece in pieces(data):
        a, b = np.searchsorted(starts, [start, start + SEGMENT])
        if a < b:
            rolling = Rolling(piece)
            for row, length in zip(out, lengths, strict=True):
                row[a:b] = rolling.of(starts[a:b] - start, length[a:b])
    return out if len(lengths) > 1 else out[0]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 20
    for batch in text_slices(batches, most=CHUNK_BYTES):
        texts = filled(batch.column("text")).cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset)
        raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()),
             pa.ListArray.from_arrays(np.array([0, batch.num_rows], dtype=np.int32), batch.column("rest")),
             pa.array([np.diff(at)], pa.list_(pa.int64())),
             pa.array([tally.packed(raw[at[0]:at[-1]])], pa.binary())], names=CHUNK_NAMES)
        chunk += 1


CHUNK_NAMES = ["chunk", "rest", "lengths", "data"]
ANCHORS = "chunk long, at binary, next binary, low binary, high binary, gram binary, name binary, after binary"
PLACES = ("at", "next", "low", "high")
HASHES = ("gram", "name", "after")


def _anchors(length: int):
    """Anchors of each chunk in order: place, place of the next one (or the text's end), hashes of the anchor string,
    of its phrase, and of the phrase with the length - 1 bytes after it. A text's start stands as an anchor too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                data, ends = tally.unpacked(row["data"], np.uint8), np.cumsum(row["lengths"], dtype=np.int64)
                inner, first, many, string = anchors_with_grams(data, ends, length)
                begins = (ends - row["lengths"])[np.array(row["lengths"]) >= length]
                at = np.union1d(inner, begins)
                end = ends[np.searchsorted(ends, at, "right")] if len(at) else at
                following = np.append(at[1:], at[-1:] + MARGIN)
                last = following >= end
                following = np.where(last, end, following)
                # A start that is no anchor by content has no string and no windows of its own.
                by_content = np.isin(at, inner)
                gram = np.zeros(len(at), dtype=U64)
                gram[by_content] = string
                low, high = np.zeros(len(at), dtype=np.int64), np.full(len(at), -1, dtype=np.int64)
                low[by_content], high[by_content] = first, first + many - 1
                phrase, after = range_hashes(data, at, following - at, np.minimum(following + length - 1, end) - at)
                with np.errstate(over="ignore"):
                    phrase = np.where(last, mix(phrase + U64(97)), phrase)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]], pa.int64()),
                     *[pa.array([tally.packed(x.astype(np.int32))], pa.binary()) for x in (at, following, low, high)],
                     *[pa.array([tally.packed(x)], pa.binary()) for x in (gram, phrase, after)]],
                    names=["chunk", *PLACES, *HASHES])
    return run


def unrolled(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, ends included."""
    n = high - low + 1
    return np.repeat(low - spans(n)[:-1], n) + np.arange(int(n.sum()))


def ranges_of(numbers: np.ndarray) -> np.ndarray:
    """Rows of the first and of the last of each range of ascending numbers."""
    if not len(numbers):
        return np.zeros((2, 0), dtype=np.int64)
    cut = np.flatnonzero(np.diff(numbers) != 1)
    return np.stack([numbers[np.append(0, cut + 1)], numbers[np.append(cut, len(numbers) - 1)]])


def rolled(numbers: np.ndarray) -> bytes:
    """Ascending numbers as packed ranges."""
    return tally.packed(ranges_of(numbers).astype(np.int32))


def ranges_in(packed: bytes) -> np.ndarray:
    return tally.unpacked(packed, np.int32).astype(np.int64).reshape(2, -1)


def numbers_of(packed: bytes) -> np.ndarray:
    return unrolled(*ranges_in(packed))


class Anchors:
    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.at, self.next, self.low, self.high = (tally.unpacked(row[c], np.int32).astype(np.int64) for c in PLACES)
        self.gram, self.name, self.after = (tally.unpacked(row[c], U64) if row.get(c) else None for c in HASHES)
        self.grams = np.unique(self.gram[self.gram > 0])

    def spread(self, per_gram: np.ndarray) -> np.ndarray:
        """A value for each anchor from one for each distinct string; 0 where there is no string."""
        if not len(self.grams):
            return np.zeros(len(self.at), dtype=per_gram.dtype)
        place = np.minimum(np.searchsorted(self.grams, self.gram), len(self.grams) - 1)
        return np.where(self.gram > 0, per_gram[place], 0)

    def windows(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of the marked anchors, in order, and the anchor of each."""
        number = np.flatnonzero(some & (self.high >= self.low))
        return unrolled(self.low[number], self.high[number]), np.repeat(number, self.high[number] - self.low[number] + 1)

    def settled(self, starts: np.ndarray, phrases: np.ndarray) -> np.ndarray:
        """Which windows start in a settled phrase."""
        done = np.zeros(len(self.at), dtype=bool)
        done[phrases] = True
        return done[np.searchsorted(self.at, starts, "right") - 1]

    def repeated(self, replies: pa.Table) -> np.ndarray:
        """Anchors whose string occurs twice or more; a text's start goes with the anchor after it."""
        yes = self.spread(tally.totals_of(replies, ANCHOR, 1)[:, 0]) > 1
        start = np.flatnonzero(self.gram == 0)
        start = start[start + 1 < len(yes)]
        yes[start] = yes[start + 1] & (self.next[start] == self.at[start + 1])
        return yes


def _ask_grams(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                a = Anchors(row)
                _, counts = np.unique(a.gram[a.gram > 0], return_counts=True)
                if len(counts):
                    yield tally.requests(row["chunk"], ANCHOR, a.grams, counts.astype(np.uint32)[:, None], bits)
    return run


STRINGS = "chunk long, i long, name long, cover long, anchor long, after long"


def _strings(_, left: pa.Table, right: pa.Table) -> pa.Table:
    """Runs of repeated anchors, each closed by a name that occurs nowhere else."""
    out = []
    for row in left.to_pylist():
        a = Anchors(row)
        yes = a.repeated(right)
        some = np.flatnonzero(yes)
        closed = np.ones(len(some), dtype=bool)
        closed[:-1] = (some[1:] != some[:-1] + 1) | (a.next[some[:-1]] != a.at[some[1:]])
        n = len(some) + int(closed.sum())
        place = np.arange(len(some)) + np.concatenate([[0], np.cumsum(closed)[:-1]]).astype(np.int64) if len(some) else some
        # Names of phrases are even, closing ones odd; 0 is left for the end of a chunk.
        name = ((np.arange(n, dtype=np.int64) + (a.chunk << STRIDE_BITS)) << 1) | 1
        name[place] = (a.name[some] << U64(1) | U64(1 << 63)).view(np.int64)
        cover, anchor, after = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
        cover[place], anchor[place] = (a.next - a.at)[some], some
        after[place] = a.after[some].view(np.int64)
        out.append(pa.table({"chunk": np.full(n, a.chunk), "i": np.arange(n), "name": name, "cover": cover,
                             "anchor": anchor, "after": after}))
    return pa.concat_tables(out) if out else pa.schema([(c, pa.int64()) for c in (
        "chunk", "i", "name", "cover", "anchor", "after")]).empty_table()


def _adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors whose phrase and continuation equal a neighbour's in suffix order."""
    held = None
    for batch in [*batches, None]:
        rows = batch if held is None else held if batch is None else pa.Table.from_batches(
            [held, batch]).combine_chunks().to_batches()[0]
        if rows is None:
            return
        name, after = (rows.column(c).to_numpy() for c in ("name", "after"))
        same = (name[1:] == name[:-1]) & (after[1:] == after[:-1])
        settled = np.append(same, False) | np.insert(same, 0, False)
        yield pa.RecordBatch.from_arrays([rows.column("chunk").filter(pa.array(settled)),
                                          rows.column("anchor").filter(pa.array(settled))], names=["chunk", "anchor"])
        held = rows.slice(rows.num_rows - 1)
        if batch is None:
            return


def _settled(strings: DataFrame, length: int) -> DataFrame:
    """Numbers of the anchors of each chunk whose phrases are settled by a neighbour in suffix order."""
    with working_tables(strings.sparkSession):  # the recursion's tables go with it
        ranks = suffix_ranks(strings.select("chunk", "i", "name", "cover"), length)
        path = scratch(strings.sparkSession, "sx-ordered")
        strings.where("anchor >= 0").join(ranks, ["chunk", "i"]).select(
            "rank", "chunk", "i", "anchor", "name", "after").write.parquet(path)
    parts = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = strings.sparkSession.read.parquet(path).repartitionByRange(
        parts, "rank", "chunk", "i").sortWithinPartitions("rank", "chunk", "i")
    pairs = ordered.select("chunk", "anchor", "name", "after").mapInArrow(_adjacent, "chunk long, anchor long")
    # Numbers of one chunk's anchors: of bounded size, as the chunk is.
    return durable(pairs.groupBy("chunk").agg(F.collect_set("anchor").alias("settled")), "sx-settled")


def repeats(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chunks of ``docs`` (text, and the struct rest that goes along), windows of each chunk that are settled or
    counted, answers to the counted ones)."""
    schema = StructType([StructField("chunk", LongType()), StructField("rest", ArrayType(docs.schema["rest"].dataType)),
                         StructField("lengths", ArrayType(LongType())), StructField("data", BinaryType())])
    chunks = durable(docs.select("text", "rest").mapInArrow(lean(_chunks), schema), "sx-chunks")
    size = chunks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, v: s + v))).first()[0] or 0
    anchors = durable(chunks.select("chunk", "lengths", "data").mapInArrow(lean(_anchors(length)), ANCHORS), "sx-anchors")
    bits = tally.bucket_bits(size // (gram_of(length) // 2))
    grams = durable(tally.tally(anchors.mapInArrow(lean(_ask_grams(bits)), tally.REQUEST)), "sx-grams")
    strings = durable(anchors.groupBy("chunk").cogroup(grams.groupBy("chunk")).applyInArrow(_strings, STRINGS), "sx-strings")
    free_shuffles(docs.sparkSession)
    facts = durable(anchors.select("chunk", *PLACES, "gram").join(_settled(strings, length), "chunk", "left"), "sx-facts")
    free_shuffles(docs.sparkSession)
    free_heaps(docs.sparkSession)

    def ask_open(_, left: pa.Table, right: pa.Table) -> pa.Table:
        """Anchor strings with a window that is not settled, here or elsewhere."""
        out = []
        for row in left.to_pylist():
            a = Anchors(row)
            starts, number = a.windows(a.repeated(right))
            rest = ~a.settled(starts, np.array(row["settled"] or [], dtype=np.int64))
            asked = np.isin(a.grams, a.gram[number[rest]]).astype(np.uint32)
            if len(a.grams):
                out.append(pa.Table.from_batches([tally.requests(row["chunk"], OPEN, a.grams, asked[:, None], bits)]))
        return pa.concat_tables(out) if out else _no_request()

    opened = durable(tally.tally(facts.groupBy("chunk").cogroup(grams.groupBy("chunk")).applyInArrow(
        ask_open, tally.REQUEST)), "sx-open")

    def plan(_, left: pa.Table, right: pa.Table) -> pa.Table:
        """Starts of windows known to be repeated, of those to be counted, and of anchors found elsewhere too."""
        out = []
        for row in left.to_pylist():
            a = Anchors(row)
            repeated = a.repeated(right)
            starts, _ = a.windows(repeated)
            yes = starts[a.settled(starts, np.array(row["settled"] or [], dtype=np.int64))]
            open_ = a.spread(tally.totals_of(right, OPEN, 1)[:, 0]) > 0 if len(a.grams) else repeated
            count, _ = a.windows(repeated & open_)
            shared = a.at[repeated & (a.gram > 0)]
            out.append((row["chunk"], rolled(yes), rolled(count), tally.packed(shared.astype(np.int32))))
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), **{c: pa.array([x[k] for x in out], pa.binary())
                         for k, c in enumerate(("yes", "counted", "shared"), start=1)}})

    plans = durable(facts.groupBy("chunk").cogroup(grams.union(opened).groupBy("chunk")).applyInArrow(
        plan, "chunk long, yes binary, counted binary, shared binary"), "sx-plans")
    many = tally.bucket_bits(size // 4)
    asked = chunks.select("chunk", "data").join(plans, "chunk").mapInArrow(lean(_ask_windows(many, length)), tally.REQUEST)
    counts = durable(tally.tally(asked), "sx-counts")
    del asked
    free_shuffles(docs.sparkSession)
    return chunks, plans, counts


def _window_hashes(row: dict, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows to be counted."""
    starts = numbers_of(row["counted"])
    return starts, range_hashes(data, starts, np.full(len(starts), length))


def _ask_windows(bits: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                _, hashes = _window_hashes(row, tally.unpacked(row["data"], np.uint8), length)
                keys, counts = np.unique(hashes, return_counts=True)
                if len(keys):
                    yield tally.requests(row["chunk"], WINDOW, keys, counts.astype(np.uint32)[:, None], bits)
    return run


def _removed(row: dict, data: np.ndarray, ends: np.ndarray, counts: pa.Table,
             length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, number of the text) of each maximal run of bytes of a chunk that repeated windows cover."""
    places, hashes = _window_hashes(row, data, length)
    keys = np.unique(hashes)
    twice = tally.totals_of(counts, WINDOW, 1)[:, 0] > 1
    more = places[twice[np.searchsorted(keys, hashes)]] if len(keys) else places
    first, last = np.concatenate([ranges_in(row["yes"]), ranges_of(more)], axis=1)
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + length)
    text = np.searchsorted(ends, first, "right")  # no window runs past its text, and a run ends with it
    opens = np.flatnonzero(np.append(True, (first[1:] > end[:-1]) | (text[1:] != text[:-1]))[:len(first)])
    return first[opens], end[np.append(opens[1:], len(first))[:len(opens)] - 1], text[opens]


def _no_request() -> pa.Table:
    return pa.table({"chunk": pa.array([], pa.int64()), "kind": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()),
                     "keys": pa.array([], pa.binary()), "counts": pa.array([], pa.binary())})


def _without(data: memoryview, start: int, end: int, gaps: list[tuple[int, int]]) -> memoryview | bytes:
    """Bytes ``start`` to ``end`` without the gaps (first byte, end) among them."""
    if not gaps:
        return data[start:end]
    edges = [start, *(e for gap in gaps for e in gap), end]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def cut_repeats(docs: DataFrame, with_text: bool = True, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs``: its columns (struct rest), n_bytes, n_removed, n_spans, kept_sha256, n_shared and, unless
    ``with_text`` is false, the kept text, without the parts of characters that a cut leaves behind.

    ``length`` is the bytes of the strings that are cut where they start elsewhere too.

    n_shared counts the anchors (strings of ``gram_of(length)`` bytes chosen by content) of the text that start elsewhere
    too. It shows passages in common that are shorter than ``length``, which are left alone: a text with n_removed has some as a rule, one
    with neither shares no long passage.

    Matches lie within one text; two places of one text count as two. Null and empty texts, and texts shorter than a
    window, lose nothing. Rows that share a doc_id are texts of their own. An empty table gives an empty result.
    """
    given = docs.select(F.col("text").cast("string").alias("text"), F.struct(*[docs[c] for c in docs.columns
                                                                               if c != "text"]).alias("rest"))
    chunks, plans, counts = repeats(given, length)

    def cut(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for number in range(left.num_rows):
            row = left.select(["lengths", "data", "yes", "counted", "shared"]).slice(number, 1).to_pylist()[0]
            data, lengths = tally.unpacked(row["data"], np.uint8), np.array(row["lengths"], dtype=np.int64)
            at = spans(lengths)
            first, end, of = _removed(row, data, at[1:], right, length)
            bounds = np.searchsorted(of, np.arange(len(lengths) + 1)).tolist()
            gaps = list(zip(first.tolist(), end.tolist(), strict=True))
            whole, edges = memoryview(data), at.tolist()
            kept = [_without(whole, a, b, gaps[j:k]) for a, b, j, k in zip(
                edges[:-1], edges[1:], bounds[:-1], bounds[1:], strict=True)]
            removed = np.bincount(of, weights=end - first, minlength=len(lengths)).astype(np.int64)
            shared = np.searchsorted(tally.unpacked(row["shared"], np.int32).astype(np.int64), at)
            rest = left.column("rest").slice(number, 1).combine_chunks().flatten()
            texts = [pa.array([bytes(k).decode(errors="ignore") for k in kept], pa.string())] if with_text else []
            out.append(pa.Table.from_arrays(
                [rest, pa.array(lengths), pa.array(removed), pa.array(np.diff(bounds)),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(np.diff(shared)), *texts],
                names=names))
        return pa.concat_tables(out)

    names = ["rest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared", *(["text"] if with_text else [])]
    schema = StructType([given.schema["rest"], *[StructField(n, StringType() if n in ("kept_sha256", "text") else LongType())
                                                 for n in names[1:]]])
    return chunks.join(plans, "chunk").groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(cut, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and n_shared of every row of ``docs``; see :func:`cut_repeats`."""
    return cut_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), with_text=False).select(
        "rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeats of ``length`` bytes cut out of their texts; n_chars, if there is one, follows. A null text
    becomes empty."""
    cut = cut_repeats(docs, length=length)
    columns = [F.col("text") if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c)
               if c == "n_chars" else F.col(f"rest.`{c}`") for c in docs.columns]
    return cut.select(*columns)

"""A bigram language model by deleted interpolation (Jelinek and Mercer, 1980).

The probability of a token is a mixture of maximum-likelihood estimates: bigram, unigram, and a uniform one over the
vocabulary and one unknown word. The mixture weights depend on a bucket, the power of two that the context's frequency
reaches. They are learned by expectation-maximisation on held-out counts: a fifth fold of the training documents is
deleted from the counts, and its tokens are explained by what is left.

Counts cover all training text. They are gathered by :mod:`tally`: a chunk of documents asks for its own distinct
unigrams and bigrams and gets back their totals, so no table of n-grams is broadcast and no token is shuffled alone.
For expectation-maximisation held-out tokens are summed in cells of a fixed grid (bucket by logarithm of bigram by
logarithm of unigram estimate), whose number does not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipekit.llm import tally
from pipekit.llm.common import U64, fold_of, free_shuffles, hash_words, mix, split_words, spans, text_slices
from pipekit.session import durable

FOLDS = 5
HELD_OUT = 1  # never learned from
DELETED = 2  # learned from; its tokens train the mixture weights
BUCKETS = 32
GRID = 4  # cells for each doubling of an estimate
ROUNDS = 60
START, END = U64(0x5354415254), U64(0x454E44)
UNI, BI = 0, 1
CHUNK = "chunk long, doc_ids array<long>, lengths array<int>, words binary, codes binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a slice as two rows, those of the deleted fold by themselves under an odd number: word keys, and
    for each document the codes of start, words, end."""
    chunk = TaskContext.get().partitionId() << 32
    for whole in text_slices(batches):
        deleted = np.array([fold_of(d, FOLDS) == DELETED for d in whole.column("doc_id").to_pylist()])
        for odd in (0, 1):
            part = whole.filter(pa.array(deleted == bool(odd)))
            if part.num_rows:
                yield _chunk(part, chunk + odd)
        chunk += 2


def _chunk(batch: pa.RecordBatch, chunk: int) -> pa.RecordBatch:
    words, codes, counts = split_words(batch.column("text"))
    keys, place = np.unique(np.concatenate([mix(hash_words(words)), mix(np.array([START, END]))]), return_inverse=True)
    ends = np.cumsum(counts)
    codes = place[codes] if len(codes) else codes
    framed = np.insert(codes, np.repeat(np.concatenate([[0], ends]), [1, *[2] * (len(ends) - 1), 1]),
                       [place[-2], *[place[-1], place[-2]] * (len(ends) - 1), place[-1]])
    # Frequent words get small numbers, which pack well.
    often = np.argsort(-np.bincount(framed, minlength=len(keys)), kind="stable")
    rank = np.empty_like(often)
    rank[often] = np.arange(len(often))
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
         pa.array([(counts + 2).tolist()], pa.list_(pa.int32())),
         pa.array([tally.packed(keys[often])], pa.binary()),
         pa.array([tally.packed(rank[framed].astype(np.uint32))], pa.binary())],
        names=["chunk", "doc_ids", "lengths", "words", "codes"])


class Chunk:
    """A chunk's tokens and its distinct n-grams."""

    def __init__(self, row: dict):
        self.doc_ids, self.lengths = row["doc_ids"], np.array(row["lengths"], dtype=np.int64)
        self.words = tally.unpacked(row["words"], U64)
        self.codes = tally.unpacked(row["codes"], np.uint32).astype(np.int64)
        at = spans(self.lengths)
        token = np.ones(len(self.codes), dtype=bool)
        token[at[:-1]] = False  # starts are contexts, not tokens
        self.token = np.flatnonzero(token)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        pair = self.codes[self.token - 1] << 32 | self.codes[self.token]
        distinct, self.pair = np.unique(pair, return_inverse=True)
        with np.errstate(over="ignore"):
            keys = mix(self.words[distinct >> 32] * U64(0x9E3779B97F4A7C15)
                       + mix(self.words[distinct & 0xFFFFFFFF]) + U64(29))
        order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[order]
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.pair = rank[self.pair]  # place of each token's bigram in key order
        order = np.argsort(self.words, kind="stable")
        self.word_keys, self.word_place = self.words[order], np.empty_like(order)
        self.word_place[order] = np.arange(len(order))
        folds = np.array([fold_of(d, FOLDS) for d in self.doc_ids])
        self.held_out, self.deleted = folds == HELD_OUT, folds == DELETED

    def counts(self, place: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Learned occurrences of each n-gram, and those of them in the deleted fold."""
        both = [np.bincount(place[some[doc]], minlength=n) for some in (~self.held_out, self.deleted)]
        return np.stack(both, axis=1).astype(np.uint32)


def _asking(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                yield tally.requests(row["chunk"], UNI, c.word_keys,
                                     c.counts(c.word_place[c.codes], c.doc, len(c.words)), bits)
                yield tally.requests(row["chunk"], BI, c.pair_keys,
                                     c.counts(c.pair, c.doc[c.token], len(c.pair_keys)), bits)
    return run


def _estimates(c: Chunk, replies: pa.Table, total: int, without_deleted: bool) -> tuple[np.ndarray, ...]:
    """Bigram and unigram estimate, context bucket and count of each token."""
    uni = tally.totals_of(replies, UNI, 2).astype(np.int64)
    bi = tally.totals_of(replies, BI, 2).astype(np.int64)
    uni, bi = ((x[:, 0] - x[:, 1] if without_deleted else x[:, 0]) for x in (uni, bi))
    word = uni[c.word_place]
    context = word[c.codes[c.token - 1]]
    count = word[c.codes[c.token]]
    two = np.where(context > 0, bi[c.pair] / np.maximum(context, 1), 0.0)
    one = count / max(total, 1)
    bucket = np.minimum(np.frexp(context.astype(np.float64))[1].astype(np.int64), BUCKETS - 1)  # shifted by 40 bits below
    return two, one, bucket, count


def learn_weights(cells: pa.Table, uniform: float) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each bucket by expectation-maximisation over cells of held-out tokens."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    bucket, n = (cells.column(c).to_numpy().astype(np.int64) for c in ("bucket", "n"))
    estimates = np.stack([cells.column("two").to_numpy() / np.maximum(n, 1), cells.column("one").to_numpy() / np.maximum(n, 1),
                          np.full(len(n), uniform)], axis=1)
    seen = np.bincount(bucket, weights=n, minlength=BUCKETS) if len(n) else np.zeros(BUCKETS)
    for _ in range(ROUNDS if len(n) else 0):
        share = weights[bucket] * estimates
        share *= (n / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(bucket, weights=share[:, j], minlength=BUCKETS) for j in range(3)], axis=1)
        # One token's worth of each component keeps all weights above zero.
        weights = (sums + 1) / (seen[:, None] + 3)
    filled = np.flatnonzero(seen)
    for k in range(BUCKETS):  # a bucket without held-out tokens takes the nearest one's weights
        if len(filled) and not seen[k]:
            weights[k] = weights[filled[np.abs(filled - k).argmin()]]
    return weights


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs`` (doc_id, text).

    Words are lower-cased (A-Z) and split at ASCII white space; a document's end is a token. Null and empty texts are
    an end alone. Rows whose crc32(doc_id as text) modulo 5 is 1 are held out: scored, never learned from. A null
    doc_id counts as the empty text there. Without training rows every estimate is uniform; an empty table gives an
    empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = durable(texts.mapInArrow(_chunks, CHUNK), "lm-chunks")
    tokens = chunks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, v: a + v))).first()[0] or 0
    bits = tally.bucket_bits(2 * tokens)
    replies = durable(tally.tally(chunks.mapInArrow(_asking(bits), tally.REQUEST)), "lm-replies")
    free_shuffles(docs.sparkSession)
    vocabulary = replies.where(F.col("kind") == UNI).groupBy("bucket").agg(F.max("distinct").alias("n")).agg(
        F.sum("n")).first()[0] or 0
    vocabulary = max(0, vocabulary - 1)  # the start is no token
    fold = F.crc32(F.coalesce(F.col("d.id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    lengths = chunks.select(F.explode(F.arrays_zip(F.col("doc_ids").alias("id"), F.col("lengths").alias("n"))).alias("d"))
    sums = lengths.select(fold.alias("f"), (F.col("d.n") - 1).cast("long").alias("n")).groupBy("f").agg(F.sum("n")).collect()
    by_fold = {int(f): int(n) for f, n in sums}
    train = sum(n for f, n in by_fold.items() if f != HELD_OUT)
    kept = train - by_fold.get(DELETED, 0)
    uniform = 1 / (vocabulary + 1)

    def cells(_, left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for row in left.to_pylist():
            c = Chunk(row)
            two, one, bucket, _ = _estimates(c, right, kept, True)
            some = c.deleted[c.doc[c.token]]
            two, one, bucket = two[some], one[some], bucket[some]
            grid = [np.where(p > 0, np.round(GRID * np.log2(np.maximum(p, 1e-30))) + 500, 0).astype(np.int64)
                    for p in (two, one)]
            cell, place = np.unique(bucket << 40 | grid[0] << 20 | grid[1], return_inverse=True)
            parts.append([cell, np.bincount(place, minlength=len(cell)), np.bincount(place, weights=two, minlength=len(cell)),
                          np.bincount(place, weights=one, minlength=len(cell))])
        cell, n, two, one = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0)] * 4
        return pa.table({"cell": cell.astype(np.int64), "n": n.astype(np.int64), "two": two.astype(float),
                         "one": one.astype(float)})

    odd = [x.where("chunk % 2 = 1").groupBy("chunk") for x in (chunks, replies)]
    summed = odd[0].cogroup(odd[1]).applyInArrow(cells, "cell long, n long, two double, one double").groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum("two").alias("two"), F.sum("one").alias("one"))
    grid = summed.select(F.shiftright("cell", 40).cast("int").alias("bucket"), "n", "two", "one").orderBy("bucket", "n", "two")
    weights = learn_weights(grid.toArrow(), uniform)
    del summed, grid, odd
    free_shuffles(docs.sparkSession)

    def scored(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            c = Chunk(row)
            two, one, bucket, count = _estimates(c, right, train, False)
            w = weights[bucket]
            p = np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] * uniform)
            base = np.log10((count + 0.5) / (train + 0.5 * (vocabulary + 1)))
            doc, n = c.doc[c.token], len(c.lengths)
            out.append(pa.table({
                "doc_id": pa.array(c.doc_ids, pa.int64()), "held_out": pa.array(c.held_out),
                "n_tokens": pa.array(c.lengths - 1), "n_known": pa.array(np.bincount(doc[count > 0], minlength=n)),
                "train_tokens": pa.array(np.full(n, train, dtype=np.int64)),
                "base_score": pa.array(np.bincount(doc, weights=base, minlength=n)),
                "score": pa.array(np.bincount(doc, weights=p, minlength=n))}))
        return pa.concat_tables(out) if out else None

    both = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk"))
    return both.applyInArrow(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                     "base_score double, score double")

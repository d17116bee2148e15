"""Grouping spelling variants: words one edit apart, the rarer one pointing to the commoner.

A word is a point: how often it holds each letter. One edit moves it by an L1 distance of two at most: one letter more,
one less, or both. Points are found by k-d trees:

1. a tree over a bounded sample of the words cuts the space into cells; every word is indexed in its own cell, and
   asks every cell whose box the edit can reach. The number of cells that takes grows with the square of the tree's
   depth, not with the words;
2. cells with many words or askers are cut into blocks by hash, every asker meeting every block, so a task holds a
   bounded number of both whatever the words are (anagrams are one point and can't be parted by a box);
3. in a block a k-d tree over the words of one length is searched by the askers of that length and of one letter
   less, its boxes pruned by how many letters more and less they need; the order of letters is compared for what is
   left.

The sample shapes cells only: no word is left out by it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipekit.llm.common import filled, ship, split_words, text_slices
from pipekit.session import durable

MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
DELETE_EVERY = 97
SAMPLE = 1 << 16  # words that shape the cells
CELL = 1 << 14  # words, and askers, of a block
CELL_CHARS = 1 << 22
LEAF = 24
MOVED_BYTES = 64  # words of more bytes are hashed one by one
# Letters: a-z, then U+00C0 to U+00FF; the last dimension is the length.
FIRST, LAST, HIGH = 0x61, 0xC0, 0xFF
DIMS = 26 + HIGH - LAST + 2


# ---------------------------------------------------------------- words

def _zero_bytes() -> np.ndarray:
    """What one more byte does to a CRC-32 by its lowest byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def joined_crc(heads: np.ndarray, which: np.ndarray, tails: list[bytes], tail_of: np.ndarray) -> np.ndarray:
    """CRC-32 of pairs of a head (its CRC given) and a tail. CRCs are linear: the head's, moved on by as many zero
    bytes as the tail has, and the tail's own add up."""
    own = np.array([zlib.crc32(t) for t in tails], dtype=np.uint32)
    size = np.array([len(t) for t in tails], dtype=np.int64)
    out = np.zeros(len(which), dtype=np.uint32)
    table, moved = _zero_bytes(), heads.copy()
    steps = size[tail_of]
    order = np.argsort(steps, kind="stable")
    edges = np.searchsorted(steps[order], np.arange(MOVED_BYTES + 2))
    for n in range(MOVED_BYTES + 1):
        pairs = order[edges[n]:edges[n + 1]]
        out[pairs] = moved[which[pairs]] ^ own[tail_of[pairs]]
        moved = table[moved & 0xFF] ^ (moved >> 8)
    for k in order[edges[-1]:].tolist():  # few words are that long
        out[k] = zlib.crc32(tails[tail_of[k]], int(heads[which[k]]))
    return out


def _counted(batches: Iterator[pa.RecordBatch], delete_every: int | None, min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        plain = pc.replace_substring_regex(pc.ascii_lower(filled(batch.column("text"))), "[^a-zÀ-ÿ]+", " ")
        words, codes, counts = split_words(plain, lower=False)
        some = np.flatnonzero(pc.utf8_length(words).to_numpy(zero_copy_only=False) >= min_chars)
        place = np.full(len(words), -1)
        place[some] = np.arange(len(some))
        words, codes = words.take(pa.array(some)), place[codes]
        doc = np.repeat(np.arange(batch.num_rows), counts)[codes >= 0]
        pair, n = np.unique(doc * (len(words) + 1) + codes[codes >= 0], return_counts=True)
        doc, code = pair // (len(words) + 1), pair % (len(words) + 1)
        shorter: Counter[str] = Counter()
        if delete_every:
            heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column("doc_id").to_pylist()],
                             dtype=np.uint32)
            h = joined_crc(heads, doc, words.cast(pa.binary()).to_pylist(), code)
            hit = h % np.uint32(delete_every) == 0
            for c, one, times in zip(code[hit].tolist(), h[hit].tolist(), n[hit].tolist(), strict=True):
                word = words[c].as_py()
                k = one % len(word)
                if len(word) > min_chars:
                    shorter[word[:k] + word[k + 1:]] += times
            n = np.where(hit, 0, n)
        total = np.bincount(code, weights=n, minlength=len(words)).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([words.take(pa.array(held)), pa.array(list(shorter.keys()), pa.string())]),
             pa.array(np.concatenate([total[held], np.array(list(shorter.values()), dtype=np.int64)]))], names=["word", "n"])


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, delete_every: int | None = None) -> DataFrame:
    """(word, n) of all letter runs, A-Z lower-cased, with so many code points and occurrences.

    With ``delete_every``, a run loses one code point where crc32 of ``id:run`` is a multiple of it.
    """
    ship(docs.sparkSession)
    part = docs.select(docs[doc_id].cast("string").alias("doc_id"), docs[text].alias("text"))
    return (part.mapInArrow(lambda b: _counted(b, delete_every, min_chars), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def letter_counts(words: list[str]) -> np.ndarray:
    """How often each word holds each letter, and its length."""
    out = np.zeros((len(words), DIMS), dtype=np.int32)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    letter = np.where(codes >= LAST, codes - LAST + 26, codes - FIRST)
    np.add.at(out, (np.repeat(np.arange(len(words)), sizes), letter), 1)
    out[:, -1] = sizes
    return out


# ---------------------------------------------------------------- trees

def unary(points: np.ndarray) -> np.ndarray:
    """Counts as bits: one for each letter and each count it reaches, so that letters more and less are bits set in one
    word and not in the other."""
    most = points.max(axis=0, initial=0)
    letter = np.repeat(np.arange(points.shape[1]), most)
    reach = np.concatenate([np.arange(1, m + 1) for m in most] or [np.zeros(0, dtype=np.int64)])
    width = max(1, -(-len(letter) // 64))
    out = np.zeros((len(points), width * 8), dtype=np.uint8)
    for a in range(0, len(points), step := max(1, (1 << 24) // max(1, len(letter)))):
        packed = np.packbits(points[a:a + step, letter] >= reach, axis=1)
        out[a:a + step, :packed.shape[1]] = packed
    return out.view(np.uint64)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


class Tree:
    """A k-d tree over letter counts: each node halves its points at one of the dimensions they differ most in and
    keeps the box around them, as the bits that all of them and that any of them have; points that are all alike are
    one leaf."""

    def __init__(self, points: np.ndarray, bits: np.ndarray, leaf: int = LEAF):
        self.bits, self.leaf = bits, leaf
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.inner: list[tuple[int, int] | None] = []
        self.held: list[np.ndarray | None] = []
        if len(points):
            self._grow(points, np.arange(len(points)))

    def _grow(self, points: np.ndarray, ids: np.ndarray) -> int:
        node = len(self.boxes)
        mine = self.bits[ids]
        self.boxes.append((np.bitwise_and.reduce(mine, axis=0), np.bitwise_or.reduce(mine, axis=0)))
        self.inner.append(None)
        self.held.append(None)
        side = halves(points, points.min(axis=0), points.max(axis=0)) if len(ids) > self.leaf else None
        if side is None:
            self.held[node] = ids
        else:
            low = points[:, side[0]] <= side[1]
            self.inner[node] = (self._grow(points[low], ids[low]), self._grow(points[~low], ids[~low]))
        return node

    def search(self, asked: np.ndarray, more: int, less: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(askers, points), in parts: pairs where the point has at most so many letters more and so many less."""
        todo = [(0, np.arange(len(asked)))] if self.boxes and len(asked) else []
        while todo:
            node, who = todo.pop()
            every, some = self.boxes[node]
            them = asked[who]
            who = who[(_bits(every & ~them) <= more) & (_bits(them & ~some) <= less)]
            if not len(who):
                continue
            if self.inner[node]:
                todo += [(child, who) for child in self.inner[node]]
                continue
            ids = self.held[node]
            points = self.bits[ids]
            for a in range(0, len(who), step := max(1, (1 << 19) // points.size)):
                them = asked[who[a:a + step]][:, None]
                q, p = np.nonzero((_bits(points & ~them) <= more) & (_bits(them & ~points) <= less))
                if len(q):
                    yield who[a:a + step][q], ids[p]


def halves(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int] | None:
    """(dimension, greatest value of the lower half) that parts the points most evenly among those dimensions that
    vary most; None if they are all alike."""
    if (lo == hi).all():
        return None
    best = None
    for d in np.argsort(-points.var(axis=0), kind="stable")[:6]:
        if lo[d] == hi[d]:
            continue
        values, counts = np.unique(points[:, d], return_counts=True)
        low = np.cumsum(counts)[:-1]
        k = int(np.argmin(np.abs(2 * low - len(points))))
        off = abs(2 * int(low[k]) - len(points))
        if best is None or off < best[0]:
            best = (off, int(d), int(values[k]))
    return best[1], best[2]


class Cells:
    """Cells of the whole space, cut at the halves of a sample; a node is (dimension, value, low child, high child),
    or a cell's number."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.nodes: list[tuple[int, int, int, int] | int] = []
        self.count = 0
        self._cut(sample, max(1, len(sample) // max(1, cells)))

    def _cut(self, points: np.ndarray, most: int) -> int:
        node = len(self.nodes)
        self.nodes.append(-1)
        side = halves(points, points.min(axis=0), points.max(axis=0)) if len(points) > most else None
        if side is None:
            self.nodes[node] = self.count
            self.count += 1
        else:
            low = points[:, side[0]] <= side[1]
            self.nodes[node] = (*side, self._cut(points[low], most), self._cut(points[~low], most))
        return node

    def own(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, who = todo.pop()
            at = self.nodes[node]
            if isinstance(at, int):
                out[who] = at
                continue
            low = points[who, at[0]] <= at[1]
            todo += [(at[2], who[low]), (at[3], who[~low])]
        return out

    def reached(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, cell): cells that can hold the point with one letter more, or one more and one less.

        A box is known by the cuts on the way to it. ``gap`` holds, for each dimension already missed, that the one
        letter more or less is spent; the length may grow by one and never shrinks.
        """
        who_out, cell_out = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int32)]
        n = len(points)
        # For each asker on the way: which dimension took the letter more and the letter less (-1: none yet).
        todo = [(0, np.arange(n), np.full(n, -1), np.full(n, -1))]
        while todo:
            node, who, more, less = todo.pop()
            if not len(who):
                continue
            at = self.nodes[node]
            if isinstance(at, int):
                who_out.append(who)
                cell_out.append(np.full(len(who), at, dtype=np.int32))
                continue
            d, cut, low, high = at
            here = points[who, d]
            if d == DIMS - 1:
                down, up = here <= cut, here + 1 > cut
                todo += [(low, who[down], more[down], less[down]), (high, who[up], more[up], less[up])]
                continue
            lower = here <= cut
            # The other side of the cut is one letter of this kind away, and no other letter has taken that step.
            lose = (here == cut + 1) & ((less == -1) | (less == d))
            gain = (here == cut) & ((more == -1) | (more == d))
            to_low, to_high = lower | lose, ~lower | gain
            todo += [(low, who[to_low], more[to_low], np.where(lower, less, d)[to_low]),
                     (high, who[to_high], np.where(lower, d, more)[to_high], less[to_high])]
        return np.concatenate(who_out), np.concatenate(cell_out)


def spelled(words: list[str], width: int) -> np.ndarray:
    """Letters of words of no more than ``width``, one row each."""
    out = np.zeros((len(words), width), dtype=np.uint8)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    out[np.arange(width) < sizes[:, None]] = codes
    return out


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each row of ``long`` is its row of ``short`` with one letter replaced, or inserted if it is wider by one."""
    n, m = short.shape[1], long.shape[1]
    if n == m:
        return (short != long).sum(axis=1) == 1
    head = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


# ---------------------------------------------------------------- pairs

ROUTE = "cell int, asks boolean, word string, n long"
PAIR = "word string, near string, near_n long"


def _routed(batches: Iterator[pa.RecordBatch], cells: Cells) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "word", 1 << 20):
        for a in range(0, batch.num_rows, 20_000):
            part = batch.slice(a, 20_000)
            words = part.column("word")
            points = letter_counts(words.to_pylist())
            who, cell = cells.reached(points)
            take = pa.array(np.concatenate([np.arange(len(points)), who]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([cells.own(points), cell]), pa.int32()),
                 pa.array(np.arange(len(take)) >= len(points)), words.take(take), part.column("n").take(take)],
                names=["cell", "asks", "word", "n"])


def _matched(table: pa.Table) -> pa.Table:
    words, asks = table.column("word").to_pylist(), table.column("asks").to_numpy()
    points = letter_counts(words)
    size = points[:, -1]
    bits = unary(points[:, :-1])
    points = points[:, points.any(axis=0)]  # letters that nobody has tell nothing apart
    pairs: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.int64),) * 2]
    for length in np.unique(size[~asks]):
        held = np.flatnonzero(~asks & (size == length))
        tree = Tree(points[held], bits[held])
        long = spelled([words[k] for k in held], int(length))
        for shorter in (0, 1):
            who = np.flatnonzero(asks & (size == length - shorter))
            short = spelled([words[k] for k in who], int(length) - shorter)
            for i, j in tree.search(bits[who], 1, 1 - shorter):
                for a in range(0, len(i), step := max(1, (1 << 22) // int(length))):
                    p, q = i[a:a + step], j[a:a + step]
                    right = one_edit(short[p], long[q])
                    pairs.append((who[p[right]], held[q[right]]))
    # Two words of one length meet both ways round; two of different lengths only as asked.
    i, j = (np.concatenate([x[k] for x in pairs]) for k in (0, 1))
    grown = size[i] < size[j]
    one, two = pa.array(np.concatenate([i, j[grown]])), pa.array(np.concatenate([j, i[grown]]))
    return pa.table({"word": table.column("word").take(one), "near": table.column("word").take(two),
                     "near_n": table.column("n").take(two)})


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 20_000):
            points = letter_counts(batch.column("word").slice(a, 20_000).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(points), pa.list_(pa.int32()))], names=["point"])


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, both ways, each once; ``vocabulary`` holds (word, n),
    distinct words of a-z and U+00C0 to U+00FF."""
    ship(vocabulary.sparkSession)
    size = vocabulary.count()
    sample = vocabulary.orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    rows = sample.select("word").mapInArrow(_vectors, "point array<int>").collect()
    points = np.array([r[0] for r in rows], dtype=np.int32).reshape(-1, DIMS)
    cells = Cells(points, -(-size // CELL)) if len(points) else Cells(np.zeros((1, DIMS), dtype=np.int32), 1)
    routed = durable(vocabulary.select("word", "n").mapInArrow(lambda b: _routed(b, cells), ROUTE), "spelling-routes")
    # One row for each cell, of which there are no more than words in the sample.
    def parts(asks: bool):
        chars = F.sum(F.when(F.col("asks") == asks, F.length("word")).otherwise(0)) / CELL_CHARS
        return F.ceil(F.greatest(F.count_if(F.col("asks") == asks) / CELL, chars, F.lit(1.0))).cast("int")

    sizes = F.broadcast(routed.groupBy("cell").agg(parts(False).alias("held_blocks"), parts(True).alias("ask_blocks")))
    mine = F.pmod(F.xxhash64("word"), F.when(F.col("asks"), F.col("ask_blocks")).otherwise(F.col("held_blocks")))
    other = F.sequence(F.lit(0), F.when(F.col("asks"), F.col("held_blocks")).otherwise(F.col("ask_blocks")) - 1)
    blocks = routed.join(sizes, "cell").select("cell", "asks", "word", "n", mine.cast("int").alias("mine"),
                                               F.explode(other).alias("other"))
    group = [F.col("cell"), F.when(F.col("asks"), F.col("other")).otherwise(F.col("mine")),
             F.when(F.col("asks"), F.col("mine")).otherwise(F.col("other"))]
    return (blocks.select(*[c.alias(k) for c, k in zip(group, ("cell", "held", "asked"), strict=True)], "asks", "word", "n")
            .groupBy("cell", "held", "asked").applyInArrow(_matched, PAIR))


# ---------------------------------------------------------------- groups

def variant_groups(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocabulary`` (word, n).

    ``form`` is the near word with the largest count (ties: the first in code-point order) if that is ``ratio`` (2 or
    more) times the word's own or more, else null; ``root`` is the last of the forms that follow, the word itself if
    it has none. An empty vocabulary gives no rows.
    """
    vocabulary = durable(vocabulary.select("word", "n"), "spelling-words")
    best = near_words(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    far = -F.col("best.less") >= ratio * F.col("n")
    formed = durable(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best.near")).alias("form"),
        F.when(far, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                     "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following forms; counts grow by the ratio with each step, so there are few and no cycles. Each
    round asks the word's direct form, whose near words are bounded by its letters, so no join key gets many rows."""
    forms = durable(forms, "spelling-links")
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("form"), F.col("root").alias("next"))
        before = roots.select("word", F.col("root").alias("before"))
        moved = durable(forms.join(ahead, "form", "left").join(before, "word")
                        .select("word", F.coalesce("next", "form").alias("root"), "before"), "spelling-roots")
        roots = moved.select("word", "root")
        if moved.where("root != before").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", delete_every: int | None = None) -> DataFrame:
    """:func:`variant_groups` of the words of ``docs``.

    Null, empty and wordless texts give no words; rows that repeat count again; a null id is the empty text where ids
    are hashed; extra columns, whatever their names, are not read; an empty table gives no rows.
    """
    return variant_groups(word_counts(docs, text, doc_id, delete_every=delete_every))

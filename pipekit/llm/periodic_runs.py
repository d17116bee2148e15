"""Periodic runs of words: stretches that repeat with one period at least four times.

Every document is searched on its own, many in one array of words in a task; nothing is shuffled. By internal pattern
matching:

1. a suffix array over the words, by doubling; a word counts as another one in each document, so suffixes of two
   documents part at once and only repeats inside one are sorted further. After round k the suffixes that begin with
   the same ``2**k`` words, one *block*, are one interval of the array;
2. blocks of ``2**k`` words at every multiple of ``2**(k-1)`` ask, by range successor in a wavelet tree over their
   interval, where they occur next. Occurrences of a block inside its own length are a progression, whose step is a
   candidate period;
3. each candidate is carried on to both sides as far as words one period apart are the same.

No run is missed. Take a run of period q and length 4q or more, and k with ``2**(k-1) < q <= 2**k`` (k = 2 for q up to
4). One of its first ``2**(k-1)`` words starts a block, which with its shift by q lies inside the run. As the block is
no shorter than q, the next occurrence can't be nearer: a word string that is no power occurs in its own repetition
at multiples of its length only. For the same reason a step of ``2**(k-1)`` or less is left to smaller blocks, and the
step is the smallest period of what it is carried on to.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pipekit.llm.common import ship, spans, split_words, text_slices

MIN_WORDS = 6
TIMES = 4
SHORTEST = 4  # words of the smallest block


class WaveletTree:
    """Bits of the values, highest first, level by level; every level stably parts zeros from ones."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros: list[np.ndarray] = []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            self.zeros.append(spans(~one))
            values = np.concatenate([values[~one], values[one]])

    def _steps(self):
        return zip(range(self.bits - 1, -1, -1), self.zeros, strict=True)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each interval [lo, hi) are less than x; x has no more bits than the values."""
        count = np.zeros(len(x), dtype=np.int64)
        for b, zeros in self._steps():
            one = (x >> b) & 1 == 1
            l0, h0 = zeros[lo], zeros[hi]
            count += np.where(one, h0 - l0, 0)
            lo, hi = np.where(one, zeros[-1] + lo - l0, l0), np.where(one, zeros[-1] + hi - h0, h0)
        return count

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest value (from 0) of each interval."""
        value = np.zeros(len(n), dtype=np.int64)
        for b, zeros in self._steps():
            l0, h0 = zeros[lo], zeros[hi]
            one = n >= h0 - l0
            n = np.where(one, n - (h0 - l0), n)
            value |= np.where(one, 1 << b, 0)
            lo, hi = np.where(one, zeros[-1] + lo - l0, l0), np.where(one, zeros[-1] + hi - h0, h0)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of each interval above x, -1 if none; x occurs in its interval."""
        n = self.below(lo, hi, x) + 1
        some = n < hi - lo
        out = np.full(len(x), -1, dtype=np.int64)
        out[some] = self.nth(lo[some], hi[some], n[some])
        return out


def block_intervals(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array, sorted by as many words as blocks can have, and for each block length the blocks that occur
    again: (length, start, interval start, interval end)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.full(n + 1, -1, dtype=np.int64)
    slots, held = np.arange(n), symbols[order]
    first = np.concatenate([[True], held[1:] != held[:-1]]) if n else np.zeros(0, dtype=bool)
    size = np.diff(np.append(np.flatnonzero(first), n))
    lo = np.repeat(np.flatnonzero(first), size)
    rank[order] = lo
    many = np.repeat(size, size) > 1
    slots, out, length = slots[many], [], 1
    while len(slots) and length < max(SHORTEST, -(-longest // TIMES)):
        at = order[slots]
        before, after = rank[at], rank[np.minimum(at + length, n)]
        turn = np.lexsort((after, before))
        at, after = at[turn], after[turn]
        order[slots] = at
        first = np.concatenate([[True], (before[1:] != before[:-1]) | (after[1:] != after[:-1])])
        heads = np.flatnonzero(first)
        size = np.diff(np.append(heads, len(at)))
        lo, size = np.repeat(slots[heads], size), np.repeat(size, size)
        rank[at] = lo
        many = size > 1
        slots, at, lo, size = slots[many], at[many], lo[many], size[many]
        length *= 2
        if length >= SHORTEST:
            ours = at % (length // 2) == 0
            out.append((length, at[ours], lo[ours], lo[ours] + size[ours]))
    return order, out


def candidate_periods(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks that occur again within their own length, and the distance."""
    order, levels = block_intervals(symbols, longest)
    if not levels:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    length = np.concatenate([np.full(len(at), k) for k, at, _, _ in levels])
    at, lo, hi = (np.concatenate([level[j] for level in levels]) for j in (1, 2, 3))
    # The tree holds the asked intervals only, and their values by rank.
    edge = np.zeros(len(order) + 1, dtype=np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi, -1)
    asked = np.cumsum(edge[:-1]) > 0
    place = spans(asked)
    held = order[asked]
    values = np.sort(held)
    tree = WaveletTree(np.searchsorted(values, held))
    nxt = tree.successor(place[lo], place[hi], np.searchsorted(values, at))
    step = np.where(nxt >= 0, values[nxt] - at, 0)
    near = (step > np.where(length > SHORTEST, length // 2, 0)) & (step <= length)
    return at[near], step[near]


def _carried(same, start: int, end: int, turn: int) -> int:
    """First place from ``start`` on, up to ``end``, where ``same`` fails; steps double."""
    at, step = start, 32
    while at != end:
        stop = min(at + step, end) if turn > 0 else max(at - step, end)
        bad = np.flatnonzero(~same(at, stop))
        if len(bad):
            return at + turn * int(bad[0])
        at, step = stop, 2 * step
    return end


def find_runs(codes: np.ndarray, counts: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each document, by start, then period; ``codes`` holds the words of all
    documents one after the other, ``counts`` how many each has."""
    bounds = spans(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    at, step = candidate_periods(doc * (int(codes.max(initial=0)) + 1) + codes, int(np.max(counts, initial=0)))
    turn = np.lexsort((at, step, doc[at]))
    at, step = at[turn], step[turn]
    i = 0
    while i < len(at):
        p, q = int(at[i]), int(step[i])
        d = int(doc[p])
        a, b = int(bounds[d]), int(bounds[d + 1])
        stop = _carried(lambda x, y: codes[x:y] == codes[x + q:y + q], p, b - q, 1)
        start = 1 + _carried(lambda x, y: (codes[y + 1:x + 1] == codes[y + 1 + q:x + 1 + q])[::-1], p, a - 1, -1)
        length = stop + q - start
        if length >= max(MIN_WORDS, TIMES * q):
            out[d].append((start - a, length, q))
        # Further blocks of this document and period up to ``stop`` lie in the same stretch.
        i += 1
        while i < len(at) and step[i] == q and at[i] < stop and doc[at[i]] == d:
            i += 1
    return [sorted(set(r), key=lambda x: (x[0], x[2])) for r in out]


def planted(doc_id, n: int) -> np.ndarray:
    """Which original word stands at each place: in every tenth document (by crc32 of its id) the words from some
    place on repeat. A null id plants nothing."""
    places = np.arange(n)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        places[a:] = a + (places[a:] - a) % p
    return places


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")
RUNS = "doc_id long, start long, length long, period long"


def _documents(batches: Iterator[pa.RecordBatch], plant: bool):
    """(id, words, runs) of each document."""
    for batch in text_slices(batches):
        ids = batch.column("doc_id").to_pylist()
        words, codes, counts = split_words(batch.column("text"), lower=False)
        if plant and len(codes):
            bounds = spans(counts)
            codes = np.concatenate([codes[b + planted(i, n)] for i, b, n in zip(ids, bounds, counts.tolist())])
        runs = find_runs(codes, counts)
        held, at = np.array(words.to_pylist(), dtype=object), 0
        for i, n, found in zip(ids, counts.tolist(), runs, strict=True):
            yield i, held[codes[at:at + n]], found
            at += n


def collapsed(words: np.ndarray, runs: list[tuple[int, int, int]]) -> str:
    """Words joined by one space, without those that stand in a run after its first period."""
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = words[keep]
    return " ".join(words.tolist())


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))


def word_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", plant: bool = False) -> DataFrame:
    """(doc_id, start, length, period): every run of every text, places counted in words."""
    def each(batches):
        rows = [(i, *run) for i, _, found in _documents(batches, plant) for run in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)],
                                         names=["doc_id", "start", "length", "period"])
    return _texts(docs, text, doc_id).mapInArrow(each, RUNS)


def run_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", plant: bool = False) -> DataFrame:
    """One row for each row of ``docs``: its number of runs, the longest one, digests of all runs and of the text
    with every run cut to its first period.

    Words stand between ASCII blanks. A null, empty or blank text has no word and no run; repeated rows and rows of
    one id are told apart and each give a row; an empty table gives none. Columns of any name may stand beside the
    two. ``plant`` first alters every tenth text by :func:`planted`.
    """
    def each(batches):
        rows = []
        for i, words, runs in _documents(batches, plant):
            best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
            rows.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                         _hex("".join(f"{s},{m},{q}\n" for s, m, q in runs)), _hex(collapsed(words, runs))))
            if len(rows) == 5000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)
    return _texts(docs, text, doc_id).mapInArrow(each, RESULT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.string() if j > 5 else pa.int64())
                                       for j in range(8)], names=names)

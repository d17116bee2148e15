"""An adaptive context-mixing range coder for token ids, many blocks at a time.

A block holds at most ``BLOCK`` ids and is coded from a fresh state, so blocks are independent and run side by side as
the lanes of NumPy arrays. Ids are renumbered by first appearance in the block. Three predictions compete:

* order 2: the id that last followed the same two ids (hashed), with a confidence,
* order 1: the id that last followed the same id, with a confidence,
* order 0: the frequencies of the block's ids so far, refreshed on a fixed schedule.

Adaptive rates mix them: the order-2 rate is selected by both confidences and by whether the two orders agree, the
order-1 rate by its own confidence; the rest goes to order 0, to ids seen since its last refresh, and to new ids.
The mixture's interval drives a 64-bit range coder with carries.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
LANES = 640
MAGIC = b"PKR1"
HEAD = struct.Struct("<4sIIII")
_HASH = 8192
_TOTAL = 1 << 20
_WORD = np.uint64(32)
_LOW = np.uint64(1 << 32)


def _refresh(t: int) -> bool:
    return t % 64 == 0 or t in (4, 8, 16, 32, 48)


class _Encoder:
    def __init__(self, lanes: int, most: int):
        self.low = np.zeros(lanes, dtype=np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        self.words = np.zeros((lanes, 2 * most + 4), dtype=np.uint32)
        self.at = np.zeros(lanes, dtype=np.int64)

    def put(self, rows: np.ndarray, cum: np.ndarray, freq: np.ndarray, total) -> None:
        step = self.range[rows] // np.asarray(total, dtype=np.uint64)
        old = self.low[rows]
        low = old + step * cum.astype(np.uint64)
        over = rows[low < old]
        back = self.at[over] - 1
        while len(over):  # carry into the words already out
            self.words[over, back] += np.uint32(1)
            more = self.words[over, back] == 0
            over, back = over[more], back[more] - 1
        size = step * freq.astype(np.uint64)
        out = np.flatnonzero(size < _LOW)
        if len(out):
            lane = rows[out]
            self.words[lane, self.at[lane]] = (low[out] >> _WORD).astype(np.uint32)
            self.at[lane] += 1
            low[out] <<= _WORD
            size[out] <<= _WORD
        self.low[rows], self.range[rows] = low, size

    def finish(self) -> list[np.ndarray]:
        lanes = np.arange(len(self.low))
        self.words[lanes, self.at] = (self.low >> _WORD).astype(np.uint32)
        self.words[lanes, self.at + 1] = (self.low & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return [w[:n + 2] for w, n in zip(self.words, self.at, strict=True)]


class _Decoder:
    def __init__(self, coded: list[np.ndarray]):
        self.words = np.zeros((len(coded), max(len(c) for c in coded) + 2), dtype=np.uint64)
        for row, c in zip(self.words, coded, strict=True):
            row[:len(c)] = c
        self.at = np.full(len(coded), 2, dtype=np.int64)
        self.gap = (self.words[:, 0] << _WORD) | self.words[:, 1]
        self.range = np.full(len(coded), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        self.step = self.range

    def peek(self, rows: np.ndarray, total) -> np.ndarray:
        total = np.asarray(total, dtype=np.uint64)
        self.step = self.range[rows] // total
        return np.minimum(self.gap[rows] // self.step, total - np.uint64(1)).astype(np.int64)

    def take(self, rows: np.ndarray, cum: np.ndarray, freq: np.ndarray) -> None:
        gap = self.gap[rows] - self.step * cum.astype(np.uint64)
        size = self.step * freq.astype(np.uint64)
        out = np.flatnonzero(size < _LOW)
        if len(out):
            lane = rows[out]
            gap[out] = (gap[out] << _WORD) | self.words[lane, self.at[lane]]
            # A damaged block may ask for more words than there are; its checksum will tell.
            self.at[lane] = np.minimum(self.at[lane] + 1, self.words.shape[1] - 1)
            size[out] <<= _WORD
        self.gap[rows], self.range[rows] = gap, size


def _renumber(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ids of each row as numbers by first appearance; places beyond a row's length do not matter."""
    order = np.argsort(ids, axis=1, kind="stable")
    ranked = np.take_along_axis(ids, order, axis=1)
    new = np.ones(ids.shape, dtype=bool)
    new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    first = np.maximum.accumulate(np.where(new, np.arange(ids.shape[1]), 0), axis=1)
    first_at = np.empty_like(order)
    np.put_along_axis(first_at, order, np.take_along_axis(order, first, axis=1), axis=1)
    seen = np.cumsum(first_at == np.arange(ids.shape[1]), axis=1) - 1
    return np.take_along_axis(seen, first_at, axis=1)


def _rate(rates: np.ndarray, at: np.ndarray, hit: np.ndarray) -> None:
    old = rates[at]
    rates[at] = np.clip(old + np.where(hit, (65536 - old) >> 4, -(old >> 4)), 2048, 63488)


def _code(lengths: np.ndarray, vocab: int, encoder: _Encoder | None, decoder: _Decoder | None,
          ids: np.ndarray | None) -> np.ndarray:
    """Run all lanes in step; lengths descend. Returns the ids."""
    lanes, most = len(lengths), int(lengths[0])
    local = _renumber(ids, lengths) if encoder else None
    out = np.zeros((lanes, most), dtype=np.int64)
    width = most + 1
    next1, sure1 = np.full(lanes * width, -1, dtype=np.int64), np.zeros(lanes * width, dtype=np.int64)
    next2, sure2 = np.full(lanes * _HASH, -1, dtype=np.int64), np.zeros(lanes * _HASH, dtype=np.int64)
    rate2, rate1 = np.full(lanes * 32, 32768, dtype=np.int64), np.full(lanes * 4, 32768, dtype=np.int64)
    rate0, fresh = np.full(lanes, 32768, dtype=np.int64), np.full(lanes, 8192, dtype=np.int64)
    count, name = np.zeros((lanes, most), dtype=np.int64), np.zeros((lanes, most), dtype=np.int64)
    known, listed = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    total0, cdf, columns, big = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64), 1, 2 * BLOCK
    every = np.arange(lanes)
    last, before = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    for t in range(most):
        live = int(np.searchsorted(-lengths, -t, "left"))  # lanes longer than t
        rows = every[:live]
        if t and _refresh(t):
            columns = int(known[:live].max()) + 1
            table = np.zeros((live, columns), dtype=np.int64)
            np.cumsum(count[:live, :columns - 1], axis=1, out=table[:, 1:])
            total0, listed = table[:, -1].copy(), known[:live].copy()
            cdf = (table + rows[:, None] * big).reshape(-1)
        p1, p2 = last[:live], before[:live]
        at1 = rows * width + p1
        at2 = rows * _HASH + ((p1 * 40503 + p2 * 9973) & (_HASH - 1))
        c1, c2, k1, k2 = next1[at1], next2[at2], sure1[at1], sure2[at2]
        has2, agree = c2 >= 0, c1 == c2
        has1 = (c1 >= 0) & ~agree
        mix2 = rows * 32 + k2 * 4 + k1 + 16 * agree
        mix1 = rows * 4 + k1
        lists, tail = listed[:live], known[:live] - listed[:live]
        m2 = np.where(has2, (_TOTAL >> 16) * rate2[mix2], 0)
        rest = _TOTAL - m2
        m1 = np.where(has1, (rest * rate1[mix1]) >> 16, 0)
        rest = rest - m1
        m0 = np.where(lists > 0, 1 + (((rest - 3) * rate0[:live]) >> 16), 0)
        rest = rest - m0
        mr = np.where(tail > 0, 1 + (((rest - 2) * fresh[:live]) >> 16), 0)
        e2, e1 = m2, m2 + m1
        e0, er = e1 + m0, e1 + m0 + mr
        if encoder:
            x = local[:live, t]
            layer = np.where(has2 & (x == c2), 0, np.where(has1 & (x == c1), 1, np.where(
                x < lists, 2, np.where(x < known[:live], 3, 4))))
            cum = np.choose(layer, [np.zeros(live, dtype=np.int64), e2, e1, e0, er])
            encoder.put(rows, cum, np.choose(layer, [m2, m1, m0, mr, _TOTAL - er]), _TOTAL)
        else:
            v = decoder.peek(rows, _TOTAL)
            layer = (v >= e2).astype(np.int64) + (v >= e1) + (v >= e0) + (v >= er)
            cum = np.choose(layer, [np.zeros(live, dtype=np.int64), e2, e1, e0, er])
            decoder.take(rows, cum, np.choose(layer, [m2, m1, m0, mr, _TOTAL - er]))
            x = np.where(layer == 0, c2, c1)
        zero, tailed, new = np.flatnonzero(layer == 2), np.flatnonzero(layer == 3), np.flatnonzero(layer == 4)
        if len(zero):
            edge = zero * columns
            if encoder:
                place = x[zero]
            else:
                v = decoder.peek(zero, total0[zero])
                place = np.searchsorted(cdf, v + zero * big, "right") - 1 - edge
                x[zero] = place
            low = cdf[edge + place]
            span, low = cdf[edge + place + 1] - low, low - zero * big
            encoder.put(zero, low, span, total0[zero]) if encoder else decoder.take(zero, low, span)
        if len(tailed):
            n, one = tail[tailed], np.ones(len(tailed), dtype=np.int64)
            if encoder:
                encoder.put(tailed, x[tailed] - lists[tailed], one, n)
            else:
                v = decoder.peek(tailed, n)
                decoder.take(tailed, v, one)
                x[tailed] = lists[tailed] + v
        if len(new):
            one = np.ones(len(new), dtype=np.int64)
            if encoder:
                v = ids[new, t]
                encoder.put(new, v, one, vocab)
            else:
                v = decoder.peek(new, vocab)
                decoder.take(new, v, one)
                x[new] = known[new]
            name[new, known[new]] = v
            known[new] += 1
        # What came trains the rates that were asked, then the contexts and counts.
        hit2, hit1 = layer == 0, c1 == x
        some = np.flatnonzero(has2)
        _rate(rate2, mix2[some], hit2[some])
        some = np.flatnonzero(has1 & ~hit2)
        _rate(rate1, mix1[some], hit1[some])
        some = np.flatnonzero((layer >= 2) & (lists > 0))
        _rate(rate0, some, layer[some] == 2)
        some = np.flatnonzero((layer >= 3) & (tail > 0))
        _rate(fresh, some, layer[some] == 3)
        for at, follow, sure, hit, k in ((at1, next1, sure1, hit1, k1), (at2, next2, sure2, c2 == x, k2)):
            follow[at] = np.where(hit | (k > 0), follow[at], x)
            sure[at] = np.where(hit, np.minimum(k + 1, 3), np.maximum(k - 1, 0))
        count[rows, x] += 1
        before[:live], last[:live] = p1, x + 1
        if decoder:
            out[:live, t] = name[rows, x]
    return out if decoder else ids


def encode_blocks(blocks: list[np.ndarray], vocab: int) -> list[bytes]:
    """Each array of at most BLOCK ids below ``vocab`` as one coded block."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    coded: list[bytes] = [b""] * len(blocks)
    for first in range(0, len(order), LANES):
        part = [k for k in order[first:first + LANES]]
        lengths = np.array([len(blocks[k]) for k in part], dtype=np.int64)
        if lengths[0] > BLOCK:
            raise ValueError(f"a block holds at most {BLOCK} ids")
        ids = np.zeros((len(part), max(1, int(lengths[0]))), dtype=np.int64)
        for row, k in zip(ids, part, strict=True):
            row[:len(blocks[k])] = blocks[k]
        encoder = _Encoder(len(part), ids.shape[1])
        if lengths[0]:
            _code(lengths, vocab, encoder, None, ids)
        for k, words in zip(part, encoder.finish(), strict=True):
            raw = np.asarray(blocks[k], dtype="<u4").tobytes()
            coded[k] = HEAD.pack(MAGIC, vocab, len(blocks[k]), zlib.crc32(raw), len(words)) + words.astype("<u4").tobytes()
    return coded


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of each coded block; a block that fails its checksum raises ValueError."""
    heads = []
    for c in coded:
        magic, vocab, n, crc, words = HEAD.unpack_from(c)
        if magic != MAGIC or len(c) != HEAD.size + 4 * words:
            raise ValueError("not a coded block")
        heads.append((vocab, n, crc))
    order = sorted(range(len(coded)), key=lambda k: (heads[k][0], -heads[k][1]))
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(coded)
    first = 0
    while first < len(order):
        vocab = heads[order[first]][0]
        part = [k for k in order[first:first + LANES] if heads[k][0] == vocab]
        first += len(part)
        lengths = np.array([heads[k][1] for k in part], dtype=np.int64)
        words = [np.frombuffer(coded[k], dtype="<u4", offset=HEAD.size) for k in part]
        ids = _code(lengths, vocab, None, _Decoder(words), None) if lengths[0] else np.zeros((len(part), 1), dtype=np.int64)
        for k, row, n in zip(part, ids, lengths, strict=True):
            out[k] = row[:n].astype(np.uint32)
            if zlib.crc32(out[k].astype("<u4").tobytes()) != heads[k][2]:
                raise ValueError("checksum of a coded block does not match")
    return out

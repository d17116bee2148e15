"""Tokenising whole texts in Arrow slices with a public tokenizer file; the file's path is a parameter."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pipekit.llm.common import filled, spans

WORDS_AT_ONCE = 1024
CACHED_WORDS = 400_000


@lru_cache(maxsize=2)
def load(path: str) -> tuple:
    """The tokenizer and a bounded cache of word ids, once for each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path), {}


def _word_ids(words: list[str], tokenizer, cache: dict[str, bytes]) -> list[bytes]:
    """Ids of each word, as little-endian 32-bit numbers. Unknown words are encoded many at a time, as one text with
    a blank between; the first CACHED_WORDS short ones of a worker are remembered."""
    out = [cache.get(w) for w in words]
    unknown = [k for k, ids in enumerate(out) if ids is None]
    for first in range(0, len(unknown), WORDS_AT_ONCE):
        some = unknown[first:first + WORDS_AT_ONCE]
        got = tokenizer.encode(" ".join([words[k] for k in some]), add_special_tokens=False)
        ids = np.array(got.ids, dtype="<u4").tobytes()
        starts = spans(np.array([len(words[k]) + 1 for k in some]))
        cuts = (4 * np.searchsorted(np.fromiter((x[0] for x in got.offsets), dtype=np.int64), starts)).tolist()
        for k, a, b in zip(some, cuts[:-1], cuts[1:], strict=True):
            out[k] = ids[a:b]
            if len(words[k]) < 24 and len(cache) < CACHED_WORDS:
                cache[words[k]] = out[k]
    return out


def encode(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, ids per text); every text ends with ``end``, a null text is empty.

    The tokenizer drops white space and never joins across it, so each distinct word of the slice is encoded once
    and its ids are laid out by word code. A tokenizer that keeps white space must not be used here.
    """
    tokenizer, cache = load(path)
    parts = pc.ascii_split_whitespace(filled(texts))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    words = _word_ids(coded.dictionary.to_pylist(), tokenizer, cache)
    ends = offsets[1:] - offsets[0]
    codes = np.insert(coded.indices.to_numpy(), ends, len(words))
    # Arrow copies the bytes of each code's ids one after another: its data buffer is the result.
    laid = pa.array([*words, np.array([end], dtype="<u4").tobytes()], pa.large_binary()).take(pa.array(codes))
    _, places, data = laid.buffers()
    at = np.frombuffer(places, dtype=np.int64, count=len(laid) + 1, offset=8 * laid.offset) // 4
    out = np.frombuffer(data, dtype="<u4", count=at[-1]) if at[-1] else np.zeros(0, dtype="<u4")
    return out, np.diff(at[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])])

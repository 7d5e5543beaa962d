"""Word shingles of texts as 63-bit hashes, computed over the UTF-8 bytes of Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tessera.llm.common import byte_table, mixed, text_buffers

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUE = byte_table(11)[_LOWER]
_LOW, _STEP = 16, np.uint64(0x9E3779B97F4A7C15)
_POWER = np.cumprod(np.full(1 << _LOW, _STEP, dtype=np.uint64))
_NEXT = np.uint64(0xD6E8FEB86659FD93)
#: Bytes that are hashed at once.
CHUNK = 1 << 21


def words_of(raw: np.ndarray, starts_of_texts: np.ndarray, values: np.ndarray = _VALUE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first bytes) of the words of `raw`; a word ends at a blank and at the end of a text. values: a random
    number for each byte. A hash is the sum of a random number for each byte at its place in the word, so that no rule relates
    the hashes of words whose bytes follow a rule."""
    if not len(raw):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    blank = _BLANK[raw]
    before = np.empty(len(raw), dtype=bool)
    before[0], before[1:] = True, blank[:-1]
    before[starts_of_texts[starts_of_texts < len(raw)]] = True
    first = np.flatnonzero(before & ~blank)
    if not len(first):
        return np.empty(0, dtype=np.uint64), first
    place = np.arange(first[0], len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw))))
    value = values[raw[first[0] :]] ^ _POWER[place & ((1 << _LOW) - 1)]
    if (high := place >> _LOW).any():
        value ^= mixed(high.astype(np.uint64))
    value = mixed(value)
    value[blank[first[0] :]] = 0
    return mixed(np.add.reduceat(value, first - first[0])), first


def _long_words(raw: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, in parts that end at blanks."""
    found, at = [], 0
    while at < len(raw):
        end = at + CHUNK
        while end < len(raw) and not (near := np.flatnonzero(_BLANK[raw[end : end + CHUNK]])).size:
            end += CHUNK
        end = len(raw) if end >= len(raw) else end + int(near[0])
        found.append(words_of(raw[at:end], np.zeros(1, dtype=np.int64))[0])
        at = end
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order."""
    for _, raw, offsets in text_buffers(texts, CHUNK):
        if len(offsets) == 2:
            yield _long_words(raw)
        else:
            hashes, first = words_of(raw, offsets[:-1])
            yield from np.split(hashes, np.searchsorted(first, offsets[1:-1]))


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles, sorted. Fewer words than `width` make one shingle; no words, none."""
    if not len(words):
        return np.empty(0, dtype=np.int64)
    n = min(width, len(words))
    joined = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        joined *= _NEXT
        joined += words[i : len(words) - n + 1 + i]
        joined = mixed(joined)
    return np.unique((joined ^ np.uint64(n)) >> np.uint64(1)).astype(np.int64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    d = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)

"""Vectorised word splitting and hashing over Arrow string buffers.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, which on UTF-8 is exactly the pattern
``[^\\x20\\x09-\\x0D]+``. A word of up to 15 bytes is its own 128-bit key (its bytes and its length); a
longer one has a BLAKE2b digest. Windows of words have Rabin-Karp values: polynomials over the prime field
of 2**31 - 1, `LANES` of them with different bases. Two different windows of n words agree in one lane with
probability n / 2**31 at most, and in all four with less than 2**-100 for windows of up to 64 words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LANES = 4
PRIME = (1 << 31) - 1
_P, _31 = np.uint64(PRIME), np.uint64(31)
_BASES = [int(x) for x in np.random.Generator(np.random.PCG64(20240501)).integers(1 << 20, PRIME - 1, LANES)]
#: Bytes of a word that its key holds, and those that count, by length.
SHORT = 15
_KEEP = np.where(np.arange(16)[None, :] < np.arange(16)[:, None], 255, 0).astype(np.uint8)
#: Words whose keys are made at a time, so that memory stays bounded in long texts.
BLOCK = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> _31)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of each text."""
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    if len(data):
        after[-1] = False
        after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves of each word's key, mixed by a bijection of all 128 bits."""
    out = np.empty((len(starts), 2), dtype=np.uint64)
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    each = np.lib.stride_tricks.sliding_window_view(padded, 16)
    for i in range(0, len(starts), BLOCK):
        first, size = starts[i : i + BLOCK], (ends - starts)[i : i + BLOCK]
        raw = each[first] & _KEEP[np.minimum(size, SHORT)]
        raw[:, SHORT] = np.minimum(size, SHORT)
        for k in np.flatnonzero(size > SHORT):
            raw[k] = np.frombuffer(hashlib.blake2b(data[first[k] : first[k] + size[k]].tobytes(), digest_size=16).digest(), dtype=np.uint8)
            raw[k, SHORT] = 255
        out[i : i + BLOCK] = raw.view("<u8")
    low, high = out[:, 0], out[:, 1]
    high = high ^ mix(low + np.uint64(0x9E3779B97F4A7C15))
    low = low ^ mix(high + np.uint64(0xD1342543DE82EF95))
    return low, high ^ mix(low)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    return word_keys(data, starts, ends)[0]


def _fold(x: np.ndarray) -> np.ndarray:
    """x < 2**63 modulo the prime, but that a few values from the prime on may stay."""
    x = (x & _P) + (x >> _31)
    return (x & _P) + (x >> _31)


def _rolling(c: np.ndarray, base: int, width: int) -> np.ndarray:
    """Polynomials of all windows: sum of c[i + j] * base**(width - 1 - j), put together from windows of powers of two."""
    total, done, power, size = None, 0, c, 1
    while True:
        if width & size:  # the words from `done` on
            part = power[done:]
            total = part if total is None else _fold(total[: len(part)] * np.uint64(pow(base, size, PRIME)) + part)
            done += size
        if size * 2 > width:
            return total[: max(len(c) - width + 1, 0)] % _P
        power = _fold(power[: max(len(power) - size, 0)] * np.uint64(pow(base, size, PRIME)) + power[size:])
        size *= 2


def window_keys(keys: tuple[np.ndarray, np.ndarray], counts: np.ndarray, width: int, lanes: int = LANES) -> tuple[np.ndarray, ...]:
    """lanes / 2 arrays of 64-bit keys of all windows of `width` words inside one text, and how many each text has."""
    n = len(keys[0])
    per = np.maximum(counts - width + 1, 0)
    if not per.sum():
        return *[np.zeros(0, dtype=np.uint64)] * (lanes // 2), per
    first = np.cumsum(counts) - counts
    marks = np.zeros(n + 1, dtype=np.int64)  # starts of windows that would run into the next text
    np.add.at(marks, first + per, 1)
    np.add.at(marks, first + counts, -1)
    inside = np.cumsum(marks)[: n - width + 1] == 0
    out = []
    for k in range(lanes // 2):
        pair = [_rolling(_fold(keys[k] >> shift & np.uint64(0xFFFFFFFF)), _BASES[2 * k + i], width)[inside] for i, shift in enumerate((np.uint64(0), np.uint64(32)))]
        out.append(mix(pair[0] << np.uint64(32) | pair[1]))
    return *out, per


def slices(batch: pa.RecordBatch | pa.Table, column: str, limit: int) -> Iterator[pa.RecordBatch | pa.Table]:
    """Consecutive rows of about `limit` bytes of text at most (one row may be longer)."""
    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit, side="right")))
        yield batch.slice(i, j - i)
        i = j

"""Vectorised scans over whole texts: words, their hashes and shingles, without a Python step per word."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U = np.uint64
_M1, _M2, _P = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives free memory back to the system: Python workers live on between tasks, beside an executor and others that need the room."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose outputs look random."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _P + U(salt))


BYTE = seeds(256, 11)


def powers(n: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    out = np.full(max(n, 1), U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def data_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (one more than texts). Nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, most: int = 1_000_000):
    """(first row, rows) of runs of texts of about `most` bytes, so that work space is bounded by that and the longest text."""
    at = data_of(texts)[1]
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, min(hi, len(texts)) - lo
        lo = hi
    release()


def word_spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of `inside`; a run never crosses one of `starts`."""
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    cut = starts[(starts > 0) & (starts < len(inside))]
    before[cut] = False
    first = np.flatnonzero(inside & ~before)
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[cut - 1] = False
    return first, np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    if not len(first):
        return np.zeros(0, np.uint64)
    lens = last - first
    begin = np.cumsum(lens) - lens
    inside = np.arange(int(lens.sum())) - np.repeat(begin, lens)
    value = BYTE[data[np.repeat(first, lens) + inside]] * powers(int(lens.max()))[inside]
    return mix(np.add.reduceat(value, begin) + lens.astype(np.uint64) * _P)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SHINGLE = seeds(5, 23) | U(1)
_SHORT = seeds(5, 29) | U(1)


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in a row and the number of each text's.

    Words are runs without ASCII white space, A-Z in lower case; a text of fewer words is one shingle.
    """
    data, at = data_of(texts)
    data = LOWER[data]
    first, last = word_spans(~SPACE[data], at[:-1])
    h = word_hashes(data, first, last)
    upto = np.searchsorted(first, at)  # words before each text
    n = np.diff(upto)
    sets, sizes = [], np.zeros(len(n), np.int64)
    if len(h) >= width:
        s = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            s += h[k:len(h) - width + 1 + k] * _SHINGLE[k]
        s = mix(s)
    for i in range(len(n)):
        if n[i] >= width:
            own = np.unique(s[upto[i]:upto[i + 1] - width + 1])
        elif n[i]:
            own = mix(np.array([(h[upto[i]:upto[i + 1]] * _SHORT[:n[i]]).sum() + U(n[i])], np.uint64))
        else:
            continue
        sets.append(own)
        sizes[i] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes

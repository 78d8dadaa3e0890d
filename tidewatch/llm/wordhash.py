"""Word and shingle hashes of many texts at once, as numpy passes over the bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _powers:
        _powers.clear()
        steps = [np.full(size, b, dtype=np.uint64) for b in (_BASE, _INVERSE)]
        for s in steps:
            s[0] = 1
        _powers[size] = (np.cumprod(steps[0], dtype=np.uint64), np.cumprod(steps[1], dtype=np.uint64))
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the byte ranges; equal ranges have equal hashes, wherever they lie."""
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets into them) for runs of rows of about `most` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word (A-Z lower-cased), and the position of each text's first word (and the end)."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, ~word[:-1]
    starts = np.flatnonzero(word & (before | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, ~word[1:]
    ends = np.flatnonzero(word & (after | cut[1:])) + 1
    up, down = _power(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles of k words, sorted; a shorter text is one shingle, one without words has none."""
    n = len(hashes)
    rolled = np.zeros(max(0, n - k + 1), dtype=np.uint64)
    for i in range(k if len(rolled) else 0):
        rolled = rolled * _STEP + hashes[i : n - k + 1 + i]
    rolled = mix(rolled)
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= k:
            yield np.unique(rolled[lo : hi - k + 1])
        elif hi > lo:
            h = np.zeros(1, dtype=np.uint64)
            for x in hashes[lo:hi]:
                h = h * _STEP + x
            yield mix(h + np.uint64(hi - lo))
        else:
            yield np.zeros(0, dtype=np.uint64)

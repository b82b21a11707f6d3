"""Sets of word shingles as sorted arrays of 63-bit hashes, computed over whole texts with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20  # bytes hashed at once
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers.append(np.cumprod(p))
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = _SPACE, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie end to end in data; bounds: the texts' ends after a leading 0.

    space says which bytes part words. Returns the hashes and, for each text, the number of words before it (and in all, last).
    With prefixes, the hashes are rows: of the words, and of their first so many bytes (0 for a word that has fewer).
    """
    solid = ~space[data]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    inner = bounds[1:-1][bounds[1:-1] < len(data)]
    starts[inner] |= solid[inner]
    ends = np.zeros(len(data), bool)
    ends[:-1] = solid[:-1] & (~solid[1:] | starts[1:])
    if len(data):
        ends[-1] = solid[-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    out = np.empty((1 + len(prefixes), len(first)), np.uint64)
    at = 0
    while at < len(first):
        upto = max(at + 1, int(np.searchsorted(last, first[at] + WINDOW, side="right")))
        lo, hi = first[at], last[upto - 1]
        up, down = _power(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = first[at:upto] - lo, last[at:upto] - lo
        out[0, at:upto] = _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        for row, k in enumerate(prefixes, 1):
            part = _mix((total[np.minimum(e, s + k)] - total[s]) * down[s] + np.uint64((k << 32) + 1))
            out[row, at:upto] = np.where(e - s >= k, part, np.uint64(0))
        at = upto
    return (out if prefixes else out[0]), np.searchsorted(first, bounds)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; a shorter sequence is one shingle, none has none."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64)
    k = min(size, n)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total += hashes[i : n - k + 1 + i] * _PLACE[i]
    return np.unique((_mix(total) >> np.uint64(1)).astype(np.int64))


def buffers(texts: pa.Array):
    """Runs of at most WINDOW bytes of whole texts: (bytes, bounds). Null texts are empty; a longer text is a run of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        upto = min(len(texts), max(at + 1, int(np.searchsorted(ends, ends[at] + WINDOW, side="right")) - 1))
        yield data[ends[at] : ends[upto]], ends[at : upto + 1] - ends[at]
        at = upto


def text_sets(texts: pa.Array, size: int = 5):
    """For each text its shingle set; null and blank texts have an empty one."""
    for data, bounds in buffers(texts):
        hashes, before = words(data, bounds)
        for lo, hi in zip(before[:-1], before[1:], strict=True):
            yield shingles(hashes[lo:hi], size)

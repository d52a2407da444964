"""Texts of an Arrow batch as flat numpy arrays: words, hashes, sliding minima.

A text is its UTF-8 bytes; NULL is empty. All work is on arrays that hold many
texts, cut into slices of bounded size, so memory follows the slice (or the
longest text) and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.Generator(np.random.PCG64(20240501))
_BYTES = _random.integers(1, 1 << 63, 256, dtype=_U)
_LOWER_BYTES = _BYTES.copy()
_LOWER_BYTES[65:91] = _BYTES[97:123]
_STEPS = _random.integers(1, 1 << 63, 64, dtype=_U) | _U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 20)
        known = np.multiply.accumulate(np.r_[_U(1), np.full(size - 1, base, dtype=_U)])
        _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of ``x`` over all 64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more entry than texts)."""
    if pc.any(pc.is_null(column)).as_py():
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets.astype(np.int64) - int(offsets[0])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes (a longer text is a range of its own)."""
    data, offsets = flat(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
    """Start and end of every word, and the index of the first word of each text."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    # Words never cross from one text to the next.
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lower: bool = False, salt: int = 0) -> np.ndarray:
    """64-bit hash of each span of bytes, the same wherever the span stands."""
    table = _LOWER_BYTES if lower else _BYTES
    if salt:
        table = mix(table + _U(salt))
    return summed_spans(prefix_sums(table[data]), starts, stops)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    summed = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * powers(_BASE, len(values)), out=summed[1:])
    return summed


def summed_spans(summed: np.ndarray, starts: np.ndarray, stops: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of spans of the values that ``summed`` is made from."""
    inverse = powers(_INVERSE, len(summed))
    return mix((summed[stops] - summed[starts]) * inverse[starts] + (stops - starts).astype(_U) + _U(salt * 0x9E37))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from each position on."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    summed = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTES[data] * powers(_BASE, len(data)), out=summed[1:])
    return mix((summed[k:] - summed[:n]) * powers(_INVERSE, n))


def run_hashes(items: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive items."""
    n = len(items) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    steps = mix(_STEPS[:k] + _U(salt)) | _U(1) if salt else _STEPS[:k]
    total = np.full(n, _U(k), dtype=_U)
    for j in range(k):
        total += items[j : j + n] * steps[j]
    return mix(total)


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the least key in each window of ``width``.

    Keys are compared by their upper half, the leftmost wins a tie: so the
    choice depends on what the window holds and on nothing around it.
    """
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best = (keys >> _U(32) << _U(32)) | np.arange(len(keys), dtype=_U)
    done = 1
    while done < width:
        step = min(done, width - done)
        best = np.minimum(best[: len(best) - step], best[step:])
        done += step
    return (best[:n] & _U(0xFFFFFFFF)).astype(np.int64)


class HashIndex:
    """Place of each known hash: open addressing in a table of numpy arrays."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.r_[keys.astype(_U), _U(0)]
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.mask = _U(size - 1)
        self.table = np.full(size, len(keys), dtype=np.int32)
        self.probes = 0
        left, slot = np.arange(len(keys), dtype=np.int32), (keys.astype(_U) & self.mask).astype(np.int64)
        while len(left):
            self.probes += 1
            free = self.table[slot] == len(keys)
            self.table[slot[free]] = left[free]
            placed = self.table[slot] == left
            left, slot = left[~placed], (slot[~placed] + 1) & (size - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place in ``keys``, or -1."""
        absent = len(self.keys) - 1
        slot = (hashes & self.mask).astype(np.int64)
        found = self.table[slot]
        result = np.where((found != absent) & (self.keys[found] == hashes), found, -1)
        open_ = np.flatnonzero((result < 0) & (found != absent))
        for step in range(1, self.probes):
            if not len(open_):
                break
            found = self.table[(slot[open_] + step) & int(self.mask)]
            hit = (found != absent) & (self.keys[found] == hashes[open_])
            result[open_[hit]] = found[hit]
            open_ = open_[~hit & (found != absent)]
        return result


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

"""CRC-32 of many byte spans at once, and of spans joined from others."""

from __future__ import annotations

import zlib

import numpy as np

_U = np.uint32

# Spans up to this many bytes go through the tables together; longer ones are summed one by one.
TOGETHER_BYTES = 64

_table = np.arange(256, dtype=_U)
for _ in range(8):
    _table = np.where(_table & _U(1), (_table >> _U(1)) ^ _U(0xEDB88320), _table >> _U(1))


def crc32_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``, as ``zlib.crc32`` gives it."""
    sizes = stops - starts
    order = np.argsort(-sizes, kind="stable")
    state = np.full(len(sizes), 0xFFFFFFFF, dtype=_U)
    first, descending = starts[order], sizes[order]
    long = int(np.searchsorted(-descending, -TOGETHER_BYTES, side="left"))
    for i in range(long):
        state[i] = zlib.crc32(data[first[i] : first[i] + descending[i]]) ^ 0xFFFFFFFF
    ends = len(sizes) - np.searchsorted(descending[::-1], np.arange(1, TOGETHER_BYTES + 1), side="left")
    for at, end in enumerate(ends.tolist()):
        if end <= long:
            break
        now = state[long:end]
        state[long:end] = _table[(now ^ data[first[long:end] + at]) & _U(255)] ^ (now >> _U(8))
    result = np.empty_like(state)
    result[order] = state ^ _U(0xFFFFFFFF)
    return result


def _shift_table(one: np.ndarray) -> np.ndarray:
    """Table of a linear map of 32 bits, by bytes: ``one`` has the image of each single bit."""
    table = np.zeros((4, 256), dtype=_U)
    for byte in range(4):
        for bit in range(8):
            table[byte, 1 << bit : 2 << bit] = table[byte, : 1 << bit] ^ one[8 * byte + bit]
    return table


def _moved(state: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (
        table[0][state & _U(255)] ^ table[1][(state >> _U(8)) & _U(255)] ^ table[2][(state >> _U(16)) & _U(255)] ^ table[3][state >> _U(24)]
    )


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps that append 0 .. TOGETHER_BYTES zero bytes, and 2**k of them."""
    bits = _U(1) << np.arange(32, dtype=_U)
    byte = _shift_table(_table[bits & _U(255)] ^ (bits >> _U(8)))
    few, image = [], bits
    for _ in range(TOGETHER_BYTES + 1):
        few.append(_shift_table(image))
        image = _moved(image, byte)
    doubled = [byte]
    for _ in range(40):
        doubled.append(_shift_table(_moved(_moved(bits, doubled[-1]), doubled[-1])))
    return np.array(few), doubled


_FEW, _DOUBLED = _tables()
_FLAT = _FEW.reshape(-1)


def joined(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of a + b from those of a and b and the number of bytes of b."""
    size = np.minimum(right_bytes, TOGETHER_BYTES).astype(np.int64) << 10
    moved = (
        _FLAT[size + (left & _U(255))]
        ^ _FLAT[size + 256 + ((left >> _U(8)) & _U(255))]
        ^ _FLAT[size + 512 + ((left >> _U(16)) & _U(255))]
        ^ _FLAT[size + 768 + (left >> _U(24))]
    )
    rest = np.flatnonzero(right_bytes > TOGETHER_BYTES)
    if len(rest):
        more = right_bytes[rest] - TOGETHER_BYTES
        value = moved[rest]
        for k in range(int(more.max()).bit_length()):
            value = np.where(more >> k & 1, _moved(value, _DOUBLED[k]), value)
        moved[rest] = value
    return moved ^ right

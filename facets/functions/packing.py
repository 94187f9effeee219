"""Sorted whole numbers in few bits: the low bits of each number as they are,
the high bits as a row of ones and zeros that counts up (Elias and Fano's
code). n numbers out of 2**bits take about ``bits - log2(n) + 2`` bits each.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<qb")


def pack_sorted(values: np.ndarray, bits: int) -> bytes:
    """``values`` (ascending, distinct, below 2**bits) as bytes."""
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0)
    values = values.astype(np.uint64)
    low = max(0, bits - int(n).bit_length())
    ones = np.arange(n) + (values >> np.uint64(low)).astype(np.int64)
    high = np.zeros(n + (1 << (bits - low)), np.uint8)
    high[ones] = 1
    tail = np.unpackbits(np.ascontiguousarray(values.astype(">u8")).view(np.uint8).reshape(n, 8), axis=1)[:, 64 - low:]
    return _HEAD.pack(n, low) + np.packbits(high).tobytes() + np.packbits(tail.ravel()).tobytes()


def unpack_sorted(packed: bytes, bits: int) -> np.ndarray:
    """The numbers that ``pack_sorted`` packed."""
    n, low = _HEAD.unpack_from(packed)
    if not n:
        return np.zeros(0, np.uint64)
    size = n + (1 << (bits - low))
    head = np.frombuffer(packed, np.uint8, -(-size // 8), _HEAD.size)
    high = (np.flatnonzero(np.unpackbits(head, count=size)) - np.arange(n)).astype(np.uint64)
    out = high << np.uint64(low)
    if low:
        tail = np.unpackbits(np.frombuffer(packed, np.uint8, -1, _HEAD.size + len(head)), count=n * low).reshape(n, low)
        wide = np.zeros((n, 64), np.uint8)
        wide[:, 64 - low:] = tail
        out |= np.packbits(wide, axis=1).view(">u8").reshape(n).astype(np.uint64)
    return out

"""Arrays of whole numbers in one compressed byte string, for rows that Spark moves."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np


def pack(arrays: Sequence[np.ndarray], ascending: Sequence[bool] = ()) -> bytes:
    """The arrays as byte planes, which compress better than whole numbers.

    Arrays marked ascending are stored as their differences.
    """
    import zstandard

    head, planes = [struct.pack("<H", len(arrays))], []
    for place, numbers in enumerate(arrays):
        numbers = np.asarray(numbers, dtype=np.uint64)
        sorted_ = place < len(ascending) and ascending[place]
        if sorted_ and len(numbers):
            numbers = np.diff(numbers, prepend=np.uint64(0))
        width = (int(numbers.max()).bit_length() + 7) // 8 if len(numbers) else 0
        head.append(struct.pack("<QBB", len(numbers), width, sorted_))
        raw = numbers.view(np.uint8).reshape(-1, 8)
        planes.extend(np.ascontiguousarray(raw[:, byte]).tobytes() for byte in range(width))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + planes))


def unpack(payload: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(payload)
    (n,) = struct.unpack_from("<H", raw)
    heads = [struct.unpack_from("<QBB", raw, 2 + 10 * k) for k in range(n)]
    at = 2 + 10 * n
    arrays = []
    for size, width, sorted_ in heads:
        numbers = np.zeros((size, 8), dtype=np.uint8)
        for byte in range(width):
            numbers[:, byte] = np.frombuffer(raw, np.uint8, size, at)
            at += size
        found = numbers.view(np.uint64).reshape(-1)
        arrays.append(np.cumsum(found, dtype=np.uint64) if sorted_ else found)
    return arrays

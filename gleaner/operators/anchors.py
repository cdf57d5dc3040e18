"""Byte strings that anchor passages in texts: rolling hashes of whole batches, and a filter of fixed size for those that are wanted."""

from __future__ import annotations

import numpy as np

BASE, MASK = 0x9E3779B97F4A7C15, 2**64 - 1
#: Bits of the filter.
BITS = 2**24
#: Bytes of texts that are hashed at a time.
BYTES = 2**20


def hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n bytes from each place on, n at least 1; powers of two are put together."""
    out, done, size, power = None, 0, 1, data.astype(np.uint64) + np.uint64(1)
    while True:
        if n & size:
            # what is done stands before this power's bytes
            out = power if out is None else out[: len(power) - done] * np.uint64(pow(BASE, size, MASK + 1)) + power[done:]
            done += size
        size *= 2
        if size > n:
            break
        half = size // 2
        power = power[: max(0, len(power) - half)] * np.uint64(pow(BASE, half, MASK + 1)) + power[half:]
    out = out[: max(0, len(data) - n + 1)]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def anchor(passage: str, length: int) -> tuple[int, int]:
    """(bytes, hash) of the string that a passage is known by: of those of its length the one with the least hash."""
    data = np.frombuffer(passage.encode(), np.uint8)
    n = min(len(data), length)
    return (n, int(hashes(data, n).min())) if n else (0, 0)


def found(ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, sizes: list[int], wanted: np.ndarray):
    """(ids, size, hashes) of texts' strings that the filter lets through, each once for a text."""
    a = 0
    while a < len(ids):
        z = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BYTES, "right")) - 1)
        part = data[offsets[a] : offsets[z]]
        row = np.repeat(np.arange(a, z), np.diff(offsets[a : z + 1]))
        for n in sizes:
            if n == 0:
                yield ids[a:z], 0, np.zeros(z - a, np.int64)
                continue
            h = hashes(part, n)
            x = h & (BITS - 1)
            hit = np.flatnonzero((wanted[x >> 3] >> (x & 7).astype(np.uint8)) & 1)
            hit = hit[row[hit] == row[hit + n - 1]]
            if len(hit):
                both = np.unique(np.stack([row[hit], h[hit]]), axis=1)
                yield ids[both[0]], n, both[1]
        a = z

"""Texts of Arrow batches as bytes: words and their 64-bit hashes, without a Python loop over words.

Words are maximal runs of bytes outside U+0020 and U+0009 to U+000D. All of them
are ASCII, so a word never starts or ends inside a UTF-8 sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19  # texts are worked on in runs of documents of about this size, so memory does not follow the batch

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MASK = (1 << 64) - 1
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Words(NamedTuple):
    """Words of a slice; ``first[i]:first[i + 1]`` are those of document ``i``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finish of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


@cache
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE)


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, b in (("up", BASE), ("down", inverse)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    up, down = _powers["up"], _powers["down"]
    if len(up) > 8 * SLICE_BYTES:  # one huge text must not hold memory for good
        _powers.clear()
    return up, down


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``limit`` bytes together; a longer text is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MIX_B)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of the documents ``data[offsets[i]:offsets[i + 1]]``; ``offsets`` starts at 0."""
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    first = np.searchsorted(starts, offsets)
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(range_hashes(data, starts, ends), starts, ends, docs, first)


WEIGHTS = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165], dtype=np.uint64)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words of one document; of the whole sequence, if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(n, width)
    return mix(window_sums(hashes, k))


def window_sums(hashes: np.ndarray, k: int) -> np.ndarray:
    """A weighted sum of every ``k`` words in a row, to be mixed."""
    out = np.full(len(hashes) - k + 1, k * int(MIX_A) & MASK, np.uint64)
    for i in range(k):
        out += hashes[i:len(hashes) - k + 1 + i] * WEIGHTS[i]
    return out

"""Small numpy helpers for text that arrives in Arrow batches."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MASK = (1 << 64) - 1


def _give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(function: Callable) -> Callable:
    """A function over Arrow batches whose worker gives its memory back when a partition ends.

    Workers live on between stages; without this each keeps the most that any stage has needed.
    """

    @wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            _give_back()

    return run


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of each row in them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about ``size`` bytes together; a larger row is a block of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random (the finalizer of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def random64(counter: np.ndarray, seed: int) -> np.ndarray:
    """Random-looking numbers addressed by a counter."""
    with np.errstate(over="ignore"):
        step = np.asarray(counter).astype(U64) * U64(0x9E3779B97F4A7C15)
        return mix64(step + U64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & _MASK))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 … base^(n-1) modulo 2^64, by doubling."""
    result = np.ones(max(n, 1), U64)
    have = 1
    while have < n:
        more = min(have, n - have)
        result[have : have + more] = result[:more] * U64(pow(base, have, 1 << 64))
        have += more
    return result[:n]


def fold(key: object, parts: int) -> int | None:
    """crc32 of a key written as text, modulo ``parts``; null has no fold."""
    return None if key is None else zlib.crc32(str(key).encode()) % parts


# Bytes that separate words: space and the control characters from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# A-Z to lower case; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in bytes that hold no word across a row's end."""
    edge = np.diff(np.concatenate(([1], SPACE[data].view(np.int8), [1])))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)

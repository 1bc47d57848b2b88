"""Word shingles of texts as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .arrays import LOWER, U64, mix64, powers, random64, row_blocks, text_bytes, word_spans

_BASE = 0xD1342543DE82EF95
_BYTES = random64(np.arange(256), 11)
_BLOCK = 1_000_000
_tables: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables[0]) < n:
        _tables[0], _tables[1] = powers(_BASE, n), powers(pow(_BASE, -1, 1 << 64), n)
    return _tables[0][:n], _tables[1][:n]


@np.errstate(over="ignore")
def word_hashes(data: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z in lower case, unless told otherwise) of bytes, and where each starts."""
    starts, ends = word_spans(data)
    up, down = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(_BYTES[LOWER[data] if lower else data] * up[:-1])))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)), starts


@np.errstate(over="ignore")
def shingle_sets(column: pa.Array, words: int = 5) -> Iterator[np.ndarray]:
    """For each text its set of distinct shingles, as sorted hashes.

    A text with fewer words than a shingle has one shingle, its whole sequence; one without words has none.
    """
    data, offsets = text_bytes(column)
    factors = random64(np.arange(words), 12) | U64(1)
    for first, last in row_blocks(offsets, _BLOCK):
        # A space after each text keeps words from running across.
        own = offsets[first : last + 1] - offsets[first]
        spaced = np.insert(data[offsets[first] : offsets[last]], own[1:], 32)
        begins = own + np.arange(len(own))
        hashes, starts = word_hashes(spaced)
        bounds = np.searchsorted(starts, begins)
        if len(hashes) >= words:
            count = len(hashes) - words + 1
            rolled = hashes[:count] * factors[0]
            for i in range(1, words):
                rolled += hashes[i : count + i] * factors[i]
            rolled = mix64(rolled)
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if high - low >= words:
                some = np.sort(rolled[low : high - words + 1])
                yield some[np.concatenate(([True], some[1:] != some[:-1]))]
            elif high > low:
                short = (hashes[low:high] * factors[: high - low]).sum(dtype=U64) + U64(high - low)
                yield mix64(np.array([short], U64))
            else:
                yield np.empty(0, U64)

"""Texts of an Arrow batch as byte arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18  # bytes of text worked on at once; their arrays take some tens of times as much
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64; kept for the worker's next piece."""
    found = _powers.get(base)
    if found is None or len(found) < n:
        steps = np.full(max(n, PIECE + 1), base, np.uint64)
        steps[0] = 1
        found = np.multiply.accumulate(steps)
        if n <= PIECE + 1:
            _powers[base] = found
    return found[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * BASE^position before each position, modulo 2^64."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * powers(BASE, len(data)), out=total[1:])
    return total


def mixed(values: np.ndarray) -> np.ndarray:
    """The values with their bits spread, in place; distinct values stay distinct."""
    values ^= values >> np.uint64(31)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(32)
    return values


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts on end, offsets of the texts); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(at) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(
    offsets: np.ndarray, size: int, overlap: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of at most about ``size`` bytes: (rows, begin, end) of their texts.

    Whole texts are taken together while they fit. A longer text comes alone, in parts that share
    ``overlap`` bytes with the next, always cut at the same places of the text.
    """
    lengths = np.diff(offsets)
    row = 0
    while row < len(lengths):
        if lengths[row] > size:
            step = size - overlap
            for begin in range(0, int(lengths[row]) - overlap, step):
                start = offsets[row] + begin
                stop = min(start + size, offsets[row + 1])
                yield np.array([row]), np.array([start]), np.array([stop])
            row += 1
            continue
        last = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        last = max(last, row + 1)
        yield np.arange(row, last), offsets[row:last], offsets[row + 1 : last + 1]
        row = last

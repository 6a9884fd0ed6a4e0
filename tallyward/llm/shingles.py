"""Word shingles of whole texts as sets of 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyward.llm.arrow import INVERSE, PIECE, mixed, powers, prefix_sums, text_bytes

# ASCII capitals become small, and these bytes part words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

STEP = np.uint64(0xD6E8FEB86659FD93)


def word_prints(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints of the words of the texts on end, number of words before each text)."""
    base = int(begin[0])
    begin, end = begin - base, end - base
    data = LOWER[data[base : base + int(end[-1])]]
    n = len(data)
    word = np.zeros(n + 2, bool)
    word[1:-1] = ~SPACE[data]
    first = word[1:] & ~word[:-1]
    last = word[:-1] & ~word[1:]
    # a word ends where its text does, whatever follows
    inner = begin[(begin > 0) & (begin < n)]
    joined = inner[word[inner] & word[inner + 1]]
    first[joined] = True
    last[joined] = True
    start, stop = np.flatnonzero(first), np.flatnonzero(last)
    total = prefix_sums(data)
    prints = (total[stop] - total[start]) * powers(INVERSE, n + 1)[start]
    return mixed(prints), np.append(np.searchsorted(start, begin), len(start))


def _stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows [a, b) whose texts have about `PIECE` bytes together."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1
        yield row, (last := min(max(last, row + 1), rows))
        row = last


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word fingerprints of one long text, part by part, cut at white space."""
    found, at = [], 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        while stop < len(data) and not SPACE[data[stop]]:
            ahead = np.flatnonzero(SPACE[data[stop : stop + PIECE]])
            stop = stop + int(ahead[0]) if len(ahead) else min(stop + PIECE, len(data))
        found.append(word_prints(data, np.array([at]), np.array([stop]))[0])
        at = stop
    return np.concatenate(found)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct fingerprints of all runs of ``size`` words, of the whole if it has fewer."""
    if not len(words):
        return words
    width = min(size, len(words))
    run = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        run = run * STEP + words[i : len(words) - width + 1 + i]
    return np.unique(mixed(run))


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text of the column, in order."""
    data, offsets = text_bytes(column)
    for a, b in _stretches(data, offsets):
        if offsets[b] - offsets[a] > PIECE:
            yield shingle_set(_long_text(data[offsets[a] : offsets[b]]), size)
            continue
        if offsets[b] == offsets[a]:
            for _ in range(a, b):
                yield np.zeros(0, np.uint64)
            continue
        words, before = word_prints(data, offsets[a:b], offsets[a + 1 : b + 1])
        for i in range(b - a):
            yield shingle_set(words[before[i] : before[i + 1]], size)

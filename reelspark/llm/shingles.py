"""Word shingles of Arrow text columns as 64-bit digests, whole batches at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLAIN = np.where(_IS_SPACE, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64)))
_LOWER = _PLAIN.copy()
_LOWER[65:91] = _PLAIN[97:123]


class WordHasher:
    """Digests of the words of UTF-8 bytes; equal words have equal digests wherever they stand."""

    def __init__(self, lower: bool = True) -> None:
        self._values = _LOWER if lower else _PLAIN
        self._powers = self._inverses = np.empty(0, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self._powers) < n:
            size = max(n, _SLICE_BYTES + 1)
            factors = np.full((2, size), _BASE, np.uint64)
            factors[1] = _INVERSE
            factors[:, 0] = 1
            self._powers, self._inverses = np.cumprod(factors, axis=1, dtype=np.uint64)

    def words(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start position and digest of each word; a word never crosses one of the ``cuts``."""
        n = len(data)
        if n == 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        self._reach(n + 1)
        space = _IS_SPACE[data]
        edge = np.empty(n + 1, bool)
        edge[0] = True
        edge[1:] = space
        edge[cuts] = True
        starts = np.flatnonzero(~space & edge[:-1])
        if not len(starts):
            return starts, np.empty(0, np.uint64)
        # Blanks count as zero, so a word's sum may run on to the next word.
        sums = np.add.reduceat(self._values[data] * self._powers[:n], starts)
        return starts, mix(sums * self._inverses[starts])


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of texts, or a very long text into runs of whole words:
    (first text, end text, bytes, cuts)."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + _SLICE_BYTES, side="right")) - 1
        if end > row:
            end = min(end, rows)
            yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end
            continue
        at, stop = int(offsets[row]), int(offsets[row + 1])
        while at < stop:
            cut = min(at + _SLICE_BYTES, stop)
            while cut < stop and not _IS_SPACE[data[cut]]:
                cut += 1
            yield row, row + 1, data[at:cut], np.array([0, cut - at])
            at = cut
        row += 1


def text_words(column: pa.Array, hasher: WordHasher) -> Iterator[np.ndarray]:
    """Word digests of each text in order; null and blank texts have none."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    held: list[np.ndarray] = []
    done = 0
    for first, end, piece, cuts in _slices(data, offsets.astype(np.int64)):
        if first > done:
            yield np.concatenate(held)
            held, done = [], first
        starts, digests = hasher.words(piece, cuts)
        if end == first + 1:
            held.append(digests)
            continue
        bounds = np.searchsorted(starts, cuts)
        for k in range(end - first):
            yield digests[bounds[k] : bounds[k + 1]]
        done = end
    if held:
        yield np.concatenate(held)
        done += 1
    for _ in range(done, len(column)):
        yield np.empty(0, np.uint64)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct digests of windows of ``size`` words; fewer words make one window."""
    if len(words) == 0:
        return np.empty(0, np.int64)
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total += words[k : len(words) - width + 1 + k] * np.uint64((_BASE * (2 * k + 3)) & _MASK)
    ordered = np.sort(mix(total).view(np.int64))
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])]

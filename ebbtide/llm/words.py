"""Words of many texts at once, as numpy arrays over Arrow buffers.

A batch of texts is one byte array. Word borders, hashes and counts per text come from
whole-array operations, so the time per word does not depend on Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
U64 = np.uint64

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (finaliser of a splitting generator)."""
    z = values.astype(U64, copy=True)
    z ^= z >> U64(30)
    z *= U64(0xBF58476D1CE4E5B9)
    z ^= z >> U64(27)
    z *= U64(0x94D049BB133111EB)
    z ^= z >> U64(31)
    return z


_OF_BYTE = mixed(np.arange(1, 257, dtype=U64) * U64(_BASE))
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; the longer is kept."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


@dataclass
class Texts:
    """Texts ``first`` to ``first + len(offsets) - 2`` of a batch as one byte array."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks_of(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Slices of a text column of about ``limit`` bytes; a longer text is a slice of its own.

    A missing text counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield Texts(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of True that do not cross a text border.

    Also the position of each text's first run in them (one more than there are texts).
    """
    n = len(inside)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    borders = offsets[:-1][offsets[:-1] < n]
    start[borders] = inside[borders]
    last = borders[borders > 0] - 1
    end[last] = inside[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) bytes, and the words ``[^\\x20\\x09-\\x0D]+`` as in ``runs``."""
    data = LOWER[texts.data]
    return (data, *runs(~SPACE[data], texts.offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of byte spans with ascending starts, one array for each array of ends.

    A rolling sum of byte values times powers of the base is taken over pieces of the
    data, so memory follows the piece (or the longest span), not the batch.
    """
    out = [np.empty(len(starts), dtype=U64) for _ in ends]
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(int(np.searchsorted(starts, low + CHUNK_BYTES)), at + 1)
        high = max(int(e[to - 1]) for e in ends)
        high = max([high, *(int(e[at:to].max()) for e in ends)])
        up, down = _power_table(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=U64)
        np.cumsum(_OF_BYTE[data[low:high]] * up[: high - low], out=sums[1:])
        first = starts[at:to] - low
        for e, o in zip(ends, out, strict=True):
            last = e[at:to] - low
            values = (sums[last] - sums[first]) * down[first]
            o[at:to] = mixed(values + (last - first).astype(U64))
        at = to
    return out


def word_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and the position of each text's first word."""
    data, starts, ends, first = words(texts)
    return span_hashes(data, starts, ends)[0], first


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``size`` words, sorted by hash.

    A text with fewer words has one shingle, the whole sequence; one without words none.
    """
    powers = [U64(pow(_BASE, 2 * k + 3, 1 << 64)) for k in range(size)]
    n = len(hashes) - size + 1
    rolled = np.zeros(max(n, 0), dtype=U64)
    for k in range(size):
        if n > 0:
            rolled += hashes[k : k + n] * powers[k]
    rolled = mixed(rolled)
    sets = []
    for low, high in zip(first[:-1], first[1:], strict=True):
        count = high - low
        if count >= size:
            sets.append(np.unique(rolled[low : high - size + 1]))
        elif count == 0:
            sets.append(np.zeros(0, dtype=U64))
        else:
            products = hashes[low:high] * np.array(powers[:count], dtype=U64)
            short = np.sum(products, dtype=U64, keepdims=True) + U64(count)
            sets.append(mixed(short ^ U64(_INVERSE)))
    return sets

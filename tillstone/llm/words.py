"""Words of whole texts as numpy arrays: the helper that runs inside tasks.

Texts arrive as Arrow columns. A slice of a batch holds about ``SLICE_BYTES`` of text, or one longer text, so a task's
memory follows its longest document and not its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: The bytes that part words, as in ``[^\x20\x09-\x0D]+``.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int) -> np.ndarray:
    """One odd 64-bit number per byte position of a word."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_MULTIPLIERS = multipliers(4096)


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them) of a text column; nulls are empty texts."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32, len(column) + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end, raw[offsets[at] : offsets[end]], (offsets[at : end + 1] - offsets[at]).astype(np.int64)
        at = end


@dataclass
class Words:
    """Words of some texts in order. ``first[d]:first[d + 1]`` are the words of text d."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, offsets: np.ndarray) -> Words:
        space = _IS_SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True  # a text ends the word of the text before it
        before, after = edge[:-1].copy(), edge[1:].copy()
        before[1:] |= space[:-1]
        after[:-1] |= space[1:]
        start = np.flatnonzero(before & ~space)
        end = np.flatnonzero(after & ~space) + 1
        return cls(raw, start, end, np.searchsorted(start, offsets))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        global _MULTIPLIERS
        if not len(self.start):
            return np.empty(0, np.uint64)
        size = self.end - self.start
        if (longest := int(size.max())) > len(_MULTIPLIERS):
            _MULTIPLIERS = multipliers(2 * longest)
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        letters = self.raw[place + np.repeat(self.start, size)].astype(np.uint64) + np.uint64(1)
        return mix64(np.add.reduceat(letters * _MULTIPLIERS[place], at))

    def text(self, first: int, last: int) -> bytes:
        """Words first to last - 1, joined by one space."""
        return b" ".join(bytes(self.raw[s:e]) for s, e in zip(self.start[first:last], self.end[first:last], strict=True))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(0x5851F42D4C957F2D) + hashes[i : i + len(total)]
    return mix64(total)

"""Vectorised text primitives shared by the operators' Arrow tasks.

A *word* is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; ASCII white
space never occurs inside a UTF-8 sequence, so byte positions are safe.
Everything works on Arrow string arrays without building Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32                       # A-Z only
_BASE = np.uint64(0x9E3779B97F4A7C15)     # odd, so powers have inverses mod 2^64
_TABLE: dict[str, np.ndarray] = {}

#: Rows are worked on in slices of about this many text bytes (a longer row is
#: one slice of its own), which bounds the working arrays of a task.
SLICE_BYTES = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i mod 2^64 for i < n, kept for the worker's life."""
    have = _TABLE.get("pow")
    if have is None or len(have) < n:
        size = max(SLICE_BYTES + 1, 1 << int(n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("pow", _BASE), ("inv", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _TABLE[name] = np.multiply.accumulate(steps)
    return _TABLE["pow"], _TABLE["inv"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hashes."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + right + np.uint64(0x632BE59BD9B4E019))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(col: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` text bytes each."""
    _, offs = string_buffers(col)
    begin, n = 0, len(offs) - 1
    while begin < n:
        end = int(np.searchsorted(offs, offs[begin] + max_bytes, side="right")) - 1
        end = min(max(end, begin + 1), n)
        yield begin, end
        begin = end


@dataclass
class Words:
    """Words of some rows: byte ranges in ``raw``, and each row's first word in ``first``."""
    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray          # length rows + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """64-bit hash of each word (A-Z lower-cased first, by default)."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        power, inverse = _powers(len(self.raw) + 1)
        upper = ((self.raw - np.uint8(65)) < 26).view(np.uint8) if lower else np.uint8(0)
        data = np.add(self.raw + (upper << np.uint8(5)), np.uint64(1), dtype=np.uint64)
        data *= power[:len(data)]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data, out=total[1:])
        length = (self.ends - self.starts).astype(np.uint64)
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts] + length)


def words_of(col: pa.Array, also_break: np.ndarray | None = None) -> Words:
    """Word table of a string column (call it on slices of bounded size)."""
    raw, offs = string_buffers(col)
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(raw, z, z, np.zeros(len(offs), np.int64))
    inside = ~_SPACE[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < n)]
    begin[cut] = inside[cut]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    stop[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begin)
    return Words(raw, starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offs))

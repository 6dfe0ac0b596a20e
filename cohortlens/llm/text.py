"""Words of whole texts as numpy arrays, straight from Arrow's bytes: no Python string is made for a word.

A word is a maximal run of characters other than space and U+0009 to U+000D. Hashes are 64 bits of the word's bytes and
the same in every task. Work goes in slices of whole documents, so memory follows the slice, or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BACK = pow(_STEP, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, so that equal low bits of sums do not show."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_hashes() -> np.ndarray:
    """A 64-bit number for each byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))


def _byte_values(lower: bool) -> np.ndarray:
    """A 64-bit number for each byte, 0 for white space; with ``lower``, A-Z have those of a-z."""
    values = byte_hashes()
    if lower:
        values[65:91] = values[97:123]
    values[is_space()] = 0
    return values


def is_space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, *range(9, 14)]] = True
    return table


class Powers:
    """Powers of the step and of its inverse, as many as the longest slice so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * SLICE_BYTES)
            with np.errstate(over="ignore"):
                self.up, self.down = (
                    np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, s, np.uint64), dtype=np.uint64)])
                    for s in (np.uint64(_STEP), np.uint64(_BACK))
                )
        return self.up, self.down


@dataclass
class Slice:
    """Some whole documents: ``data`` their bytes, document d at ``offsets[d]:offsets[d + 1]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Byte ranges of the words of a slice, and the document of each."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The documents of a string column (null: empty), some whole ones at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    # no copy of the column: its bytes are read where they lie
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield Slice(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def words(part: Slice) -> Words:
    n = len(part.data)
    inside = ~is_space()[part.data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = part.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(starts)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(part.offsets, start, side="right") - 1)


class Hasher:
    """64-bit hashes of words; with ``lower``, A-Z count as a-z."""

    def __init__(self, lower: bool) -> None:
        self.values, self.powers = _byte_values(lower), Powers()

    def __call__(self, part: Slice, found: Words) -> np.ndarray:
        if len(found.start) == 0:
            return np.zeros(0, np.uint64)
        up, down = self.powers.to(len(part.data) + 1)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(self.values[part.data] * up[: len(part.data)], found.start)
            return mixed(sums * down[found.start])


class Ranges:
    """Hashes of any ranges of the same bytes, each byte counted by its number in ``values``."""

    def __init__(self, data: np.ndarray, values: np.ndarray, powers: Powers) -> None:
        up, self.down = powers.to(len(data) + 1)
        self.upto = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values[data] * up[: len(data)], out=self.upto[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.upto[end] - self.upto[start]) * self.down[start] + np.uint64(salt * _STEP % (1 << 64)))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbours, whether or not they lie in one document."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out *= np.uint64(0xD6E8FEB86659FD93)
            out += hashes[j : j + n]
        return mixed(out)


def per_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the bytes marked in ``mask`` each document has."""
    upto = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def code_points(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of each character."""
    return (data & 0xC0) != 0x80

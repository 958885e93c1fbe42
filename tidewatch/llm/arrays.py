"""Words and rolling hashes of Arrow text columns, as numpy arrays.

Texts are taken as UTF-8 bytes straight from the Arrow buffer, in slices of whole documents of
about ``SLICE`` bytes, so that memory follows the slice and the longest text, not the batch.
A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. A null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ROOT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shifts and odd multipliers)."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


#: A random 64-bit value for each byte; upper-case ASCII has that of lower case in the second.
BYTES = mix(np.arange(1, 257, dtype=_U) * _U(_ROOT))
FOLDED = BYTES.copy()
FOLDED[65:91] = BYTES[97:123]


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                x = np.full(n, base & _MASK, _U)
                x[0] = 1
                setattr(self, name, np.cumprod(x))


_ONE, TWO = Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5)


class Rolling:
    """Hash of any stretch of a sequence of 64-bit values from two prefix sums."""

    def __init__(self, values: np.ndarray, powers: Powers = _ONE):
        powers.grow(len(values) + 1)
        self.powers = powers
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * powers.up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.powers.down[start])


def wide(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each stretch: two independent 64-bit hashes."""
    return Rolling(values).of(start, end), Rolling(mix(values), TWO).of(start, end)


@dataclass
class Slice:
    """Whole documents ``first`` to ``first + len(offsets) - 2`` of a batch."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[Slice]:
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, place, data = column.buffers()
    offsets = np.frombuffer(place, np.int64, n + 1, 8 * column.offset)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield Slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Words of a slice: byte places, and per document the range of its words."""

    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def documents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def words(part: Slice, blank: np.ndarray = _SPACE) -> Words:
    """The words of a slice; ``blank`` tells the bytes between words."""
    data, offsets = part.data, part.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    space = blank[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    start = np.flatnonzero(~space & before)
    return Words(start, np.flatnonzero(~space & after) + 1, np.searchsorted(start, offsets))


def word_hashes(part: Slice, found: Words, table: np.ndarray = BYTES) -> np.ndarray:
    return Rolling(table[part.data]).of(found.start, found.end)


def windows(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the stretches of ``width`` items that lie within one document, and per document
    the range of its stretches."""
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    places = np.concatenate(([0], np.cumsum(counts)))
    shift = np.repeat(offsets[:-1] - places[:-1], counts)
    return np.arange(places[-1]) + shift, places


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` items lie in one of the stretches of ``width`` items."""
    if not len(starts):
        return np.zeros(n, bool)
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(edge[:-1]) > 0

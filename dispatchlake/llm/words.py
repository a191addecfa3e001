"""Words, word hashes and rolling n-gram hashes of whole texts, as numpy arrays.

Every operator of this subpackage that looks at words does it here: the bytes of an Arrow
string column are classified at once, so no Python object is made for a word.

Texts are cut into slices of bounded size between documents, so memory follows the slice and the
longest single text, never the batch. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
HASH_BYTES = 1 << 18


def _table(separators: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes belong to words, all but those in the given inclusive ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


#: Words between ASCII white space.
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)])
#: Letters, digits and whatever is not ASCII.
ALNUM = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Two independent bases for word sequences.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BYTE_BASE, HASH_BYTES)
_INV = _powers(pow(_BYTE_BASE, -1, 1 << 64), HASH_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """The words of some texts, in order: text i has words offsets[i] to offsets[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def valid(self, k: int) -> np.ndarray:
        """Whether the k words from each word on are of one text."""
        return np.arange(k, len(self.starts) + k) <= np.repeat(self.offsets[1:], self.counts())


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of texts of about `most` bytes together."""
    base = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        data, offsets = buffers(chunk)
        a = 0
        while a < len(chunk):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
            yield base + a, base + b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            a = b
        base += len(chunk)


def split(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED, lower: bool = False, hashed: bool = True) -> Words:
    """The words of texts that lie one after the other in `data`."""
    if lower:
        data = _LOWER[data]
    inside = table[data]
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets[:-1]] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[first[:n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[:-1][first[1:n]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets), _hash(data, starts, ends) if hashed else np.zeros(0, np.uint64))


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], a polynomial of the bytes mixed with the length."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + HASH_BYTES, side="right"))
        if j <= i:  # one word longer than the tables
            j = i + 1
            pow_, inv = _powers(_BYTE_BASE, int(ends[i] - base)), np.ones(1, np.uint64)
        else:
            pow_, inv = _POW, _INV
        piece = data[base : ends[j - 1]].astype(np.uint64)
        piece += np.uint64(1)
        piece *= pow_[: len(piece)]
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(piece, out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * inv[s]
        out[i:j] += (e - s).astype(np.uint64) << np.uint64(48)
        i = j
    return mix(out)


def ngrams(hashes: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Hashes of the k consecutive words from each word on; len(hashes) - k + 1 of them."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    out, length, block, size = None, 0, hashes, 1
    while True:
        if k & size:
            if out is None:
                out, length = block, size
            else:
                # the block's words come first, what was gathered so far follows
                m = min(len(block), len(out) - size)
                out = block[:m] * np.uint64(pow(base, length, 1 << 64)) + out[size : size + m]
                length += size
        if size * 2 > k:
            break
        block = block[:-size] * np.uint64(pow(base, size, 1 << 64)) + block[size:]
        size *= 2
    return mix(out[: n - k + 1])


def sliding(values: np.ndarray, width: int, function) -> np.ndarray:
    """function (np.minimum or np.maximum) over each `width` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = function(values[:-size], values[size:])
        size *= 2
    return function(values[: len(values) - (width - size)], values[width - size :]) if size < width else values

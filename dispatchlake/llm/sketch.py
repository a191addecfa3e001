"""Count-min sketches of 64-bit values that every partition fills and a shuffle merges.

A sketch has `rows` rows of 2**bits counters. A partition sends the counters that it has touched,
cut into chunks of 65,536, so what is shuffled follows the values, not the sketch's width; the
counts of a chunk are summed in one group. The estimate of a value is the least of its counters:
never below the true count. What is kept, and broadcast, is one bit for each counter (at least two
or not) and the counters of at least `heavy` with their counts, both of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import mix

CHUNK_BITS = 16
#: Broadcast bits for all rows together, at most: 128 MB. A wider input only lets more values pass.
MOST_BITS = 30
#: Heavy counters that are kept, at most; the threshold doubles until they fit.
MOST_HEAVY = 1 << 20
FLUSH = 1 << 21
_SEEDS = (0x9AE16A3B2F90404F, 0xC949D7C7509E6557, 0x8CB92BA72F3D8DD7, 0xE7037ED1A0B428DB)

EMITTED = "row int, chunk int, lows binary, many binary, times binary"


def bits_for(values: float, rows: int, load: int = 4) -> int:
    """Width of a row, as a power of two, with about `load` counters for each value."""
    wanted = max(CHUNK_BITS, int(np.ceil(np.log2(max(values, 1) * load))))
    return min(wanted, MOST_BITS - int(np.ceil(np.log2(rows))))


def slots(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(values ^ np.uint64(_SEEDS[row])) >> np.uint64(64 - bits)


def filler(values_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], rows: int, bits: int):
    """A function for mapInArrow that sketches the values that `values_of` yields from its partition."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values = np.concatenate(held)
        for row in range(rows):
            found, times = np.unique(slots(values, row, bits).astype(np.uint32), return_counts=True)
            lows, chunk = (found & np.uint32(0xFFFF)).astype("<u2"), found >> np.uint32(CHUNK_BITS)
            chunks, at = np.unique(chunk, return_index=True)
            more = times > 1
            before = np.concatenate([[0], np.cumsum(more)])
            many, extra = lows[more], np.minimum(times[more], 1 << 30).astype("<u4")
            ends = [*at[1:].tolist(), len(found)]
            table = {"row": [], "chunk": [], "lows": [], "many": [], "times": []}
            for c, a, b in zip(chunks.tolist(), at.tolist(), ends, strict=True):
                table["row"].append(row)
                table["chunk"].append(c)
                table["lows"].append(lows[a:b].tobytes())
                table["many"].append(many[before[a] : before[b]].tobytes())
                table["times"].append(extra[before[a] : before[b]].tobytes())
            yield pa.RecordBatch.from_pydict(table, schema=_SCHEMA)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for values in values_of(batch):
                held.append(values)
                size += len(values)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    return fill


_SCHEMA = pa.schema([("row", pa.int32()), ("chunk", pa.int32()), ("lows", pa.binary()), ("many", pa.binary()), ("times", pa.binary())])
_MERGED = pa.schema([("row", pa.int32()), ("chunk", pa.int32()), ("repeated", pa.binary()), ("heavy", pa.binary()), ("counts", pa.binary())])


def _merger(heavy: int):
    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CHUNK_BITS, np.int64)
        for batch in batches:
            for lows, many, times in zip(*(batch.column(c).to_pylist() for c in ("lows", "many", "times")), strict=True):
                counts[np.frombuffer(lows, "<u2")] += 1
                counts[np.frombuffer(many, "<u2")] += np.frombuffer(times, "<u4").astype(np.int64) - 1
        most = np.flatnonzero(counts >= heavy) if heavy else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "row": [key[0].as_py()],
                "chunk": [key[1].as_py()],
                "repeated": [np.packbits(counts >= 2, bitorder="little").tobytes()],
                "heavy": [most.astype("<u2").tobytes()],
                "counts": [np.minimum(counts[most], (1 << 32) - 1).astype("<u4").tobytes()],
            },
            schema=_MERGED,
        )

    return merge


class Sketch:
    """The merged sketch: broadcast it, then ask for many values at once."""

    def __init__(self, bits: int, repeated: list[np.ndarray], heavy: np.ndarray, counts: np.ndarray):
        self.bits, self.repeated, self.heavy, self.counts = bits, repeated, heavy, counts

    def at_least_two(self, values: np.ndarray) -> np.ndarray:
        """Whether a value may occur twice: true for every one that does."""
        out = np.ones(len(values), dtype=bool)
        for row, bitmap in enumerate(self.repeated):
            at = slots(values, row, self.bits)
            out &= (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out

    def rarity(self, values: np.ndarray) -> np.ndarray:
        """0 for a value that occurs once, 1 for few times, then 2 and up with the logarithm of the first row's
        count: the same for equal values wherever they are."""
        out = self.at_least_two(values).astype(np.int8)
        if len(self.heavy):
            at = slots(values, 0, self.bits).astype(np.uint32)
            found = np.minimum(np.searchsorted(self.heavy, at), len(self.heavy) - 1)
            hit = (self.heavy[found] == at) & (out > 0)
            out[hit] = np.log2(self.counts[found[hit]]).astype(np.int8)
        return out


def gather(emitted: DataFrame, rows: int, bits: int, heavy: int = 0) -> Sketch:
    """Merges what the partitions have sent. To the driver come 2**bits bits for each row, and at most
    MOST_HEAVY heavy counters."""
    merged = emitted.groupBy("row", "chunk").applyInArrow(_merger(heavy), "row int, chunk int, repeated binary, heavy binary, counts binary")
    bitmaps = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(rows)]
    width = 1 << (CHUNK_BITS - 3)
    most, counts = [], []
    threshold = heavy
    for r in merged.toLocalIterator(prefetchPartitions=True):
        bitmaps[r["row"]][r["chunk"] * width : (r["chunk"] + 1) * width] = np.frombuffer(r["repeated"], np.uint8)
        if heavy and r["row"] == 0 and r["heavy"]:
            low, n = np.frombuffer(r["heavy"], "<u2"), np.frombuffer(r["counts"], "<u4")
            keep = n >= threshold
            most.append(low[keep].astype(np.uint32) + np.uint32(r["chunk"] << CHUNK_BITS))
            counts.append(n[keep])
            while sum(map(len, most)) > MOST_HEAVY:
                threshold *= 2
                most, counts = [m[c >= threshold] for m, c in zip(most, counts, strict=True)], [c[c >= threshold] for c in counts]
    slot = np.concatenate(most) if most else np.zeros(0, np.uint32)
    count = np.concatenate(counts) if counts else np.zeros(0, np.uint32)
    order = np.argsort(slot)
    return Sketch(bits, bitmaps, slot[order], count[order])

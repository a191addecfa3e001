"""Benchmark decontamination: words of training texts that repeat a benchmark item are hit.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. An item's windows are
its n consecutive words, or all of them where it has fewer. The distinct windows form a hash set that is
broadcast as arrays: the items' words, one after the other, and by length the windows' sorted hashes with the
first word of one occurrence and the ids of the items that have them. Texts are scanned with rolling hashes, and
every occurrence whose hash hits is verified against the window's own bytes. Hit words are those inside any
occurrence of a window. However many items share a window, an occurrence meets it once, and a text's items are
put together once for the windows that it has.

The benchmark is broadcast in parts of about `most` bytes of text; the arrays of a part take at most
eleven times as much (a word of one byte has 8 bytes of hash and 12 of places). A benchmark of any size
is used whole: each further part is one more scan of the written result of the one before, and one part
is held at a time.

Null texts and items have no words and are never hit; nor are empty ones. Repeated items count once for
each item id; null ids are left out of the list of items, though their words are hit. A text without
words is not contaminated. Repeated rows and ids are judged row by row; columns of any name are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import words
from .shared import bounded_batches, forget, fresh, saved

N = 13
#: A document is contaminated when 1 / CONTAMINATED_PART of its words are hit.
CONTAMINATED_PART = 20
#: Benchmark items whose windows are broadcast together: at most about so many bytes of text.
BROADCAST_BYTES = 16 << 20
#: Occurrences that are verified at once.
CHUNK = 1 << 16


class Found(NamedTuple):
    """What the texts of a slice have: which of their words are hit, and the distinct (text, window) pairs."""

    covered: np.ndarray
    texts: np.ndarray
    windows: np.ndarray


class Windows:
    """The distinct windows of some items: their words as bytes, and by length their sorted hashes, the first word of
    each, and a number. Of each number `items` has the ids, by their place in `ids`."""

    def __init__(self, items: pa.Table, n: int):
        given = items.column("item_id").to_pylist()
        #: The ids, sorted as strings.
        self.ids = sorted({i for i in given if i is not None})
        place = {i: k for k, i in enumerate(self.ids)}
        pieces, starts, ends, counts, hashes, base = [], [], [], [], [], 0
        for _, _, data, offsets in words.slices(items.column("text")):
            w = words.split(data, offsets, words.ALNUM, lower=True)
            # only word bytes are kept: a window is compared word by word
            pieces.append(w.data.tobytes())
            starts.append(w.starts + base)
            ends.append(w.ends + base)
            counts.append(w.counts())
            hashes.append(w.hashes)
            base += len(w.data)
        join = lambda arrays, kind: np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)
        self.data, self.starts, self.ends = np.frombuffer(b"".join(pieces), np.uint8), join(starts, np.uint32), join(ends, np.uint32)
        counts, hashes = join(counts, np.int64), join(hashes, np.uint64)
        known: dict[bytes, int] = {}
        raw = self.data.tobytes()
        word = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)], np.int32)
        of, first = np.repeat(np.arange(len(counts)), counts), np.concatenate([[0], np.cumsum(counts)])
        lengths = np.minimum(counts, n)[of]
        left = np.repeat(first[1:], counts) - np.arange(len(of))
        item = np.array([-1 if i is None else place[i] for i in given], np.int32)[of]
        self.by_length, pairs, total = {}, [], 0
        for k in np.unique(lengths).tolist():
            at = np.flatnonzero((lengths == k) & (left >= k))
            grams = words.ngrams(hashes, k)[at]
            order = np.lexsort([word[at + j] for j in reversed(range(k))] + [grams])
            at, grams = at[order], grams[order]
            new = np.ones(len(at), dtype=bool)
            new[1:] = grams[1:] != grams[:-1]
            for j in range(k):
                new[1:] |= word[at[1:] + j] != word[at[:-1] + j]
            number = np.cumsum(new) - 1
            self.by_length[k] = (grams[new], at[new].astype(np.uint32), total)
            pairs.append(np.stack([number + total, item[at]], axis=1))
            total += int(new.sum())
        held = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        held = held[held[:, 1] >= 0]
        self.items, self.bounds = held[:, 1].astype(np.int32), np.searchsorted(held[:, 0], np.arange(total + 1)).astype(np.uint32)
        self.told: dict[bytes, np.ndarray] = {}

    def size(self) -> int:
        """Bytes of all arrays."""
        arrays = [self.data, self.starts, self.ends, self.items, self.bounds, *(a for of in self.by_length.values() for a in of[:2])]
        return sum(a.nbytes for a in arrays)

    def find(self, w: words.Words) -> Found:
        change = np.zeros(len(w.starts) + 1, np.int32)
        texts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (hashes, first, base) in self.by_length.items():
            grams = words.ngrams(w.hashes, k)
            low = np.searchsorted(hashes, grams)
            hit = np.flatnonzero((hashes[np.minimum(low, len(hashes) - 1)] == grams) & w.valid(k)[: len(grams)])
            at = low[hit]
            while len(hit):  # once, but for windows of different words whose hashes are equal
                same = np.concatenate([self._equal(w, hit[i : i + CHUNK], first[at[i : i + CHUNK]], k) for i in range(0, len(hit), CHUNK)])
                own = hit[same]
                change[: len(w.starts)] += np.bincount(own, minlength=len(w.starts)).astype(np.int32)
                change -= np.bincount(own + k, minlength=len(change)).astype(np.int32)
                seen = np.unique((np.searchsorted(w.offsets, own, side="right") - 1) * len(hashes) + at[same])
                texts.append(seen // len(hashes))
                windows.append(seen % len(hashes) + base)
                more = (at + 1 < len(hashes)) & (hashes[np.minimum(at + 1, len(hashes) - 1)] == grams[hit])
                hit, at = hit[more], at[more] + 1
        return Found(np.cumsum(change[:-1]) > 0, np.concatenate(texts), np.concatenate(windows))

    def _equal(self, w: words.Words, at: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
        """Whether the k words from each `at` on are byte for byte those from `first` on."""
        same = np.ones(len(at), dtype=bool)
        for j in range(k):
            a, b = w.starts[at + j].astype(np.int64), self.starts[first + j].astype(np.int64)
            n = w.ends[at + j] - a
            same &= n == self.ends[first + j] - b
            rows = np.flatnonzero(same)
            a, b, n = a[rows], b[rows], n[rows]
            if not len(rows):
                break
            begins = np.cumsum(n) - n
            step = np.arange(int(n.sum())) - np.repeat(begins, n)
            differ = w.data[np.repeat(a, n) + step] != self.data[np.repeat(b, n) + step]
            same[rows[np.logical_or.reduceat(differ, begins)]] = False
        return same

    def items_of(self, windows: np.ndarray) -> np.ndarray:
        """The items that have any of these windows; put together once for each set of windows."""
        key = np.sort(windows).tobytes()
        if key not in self.told:
            if len(self.told) >= 1000:
                self.told.clear()
            self.told[key] = np.unique(np.concatenate([self.items[self.bounds[x] : self.bounds[x + 1]] for x in windows.tolist()] + [np.zeros(0, np.int32)]))
        return self.told[key]

    def items_by_text(self, found: Found, texts: int) -> list[np.ndarray]:
        order = np.argsort(found.texts, kind="stable")
        bounds = np.searchsorted(found.texts[order], np.arange(texts + 1))
        windows = found.windows[order]
        return [self.items_of(windows[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def spans(covered: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, text) of every run of hit words, words counted from their text's first."""
    first = np.zeros(len(covered) + 1, dtype=bool)
    first[offsets[:-1]] = True
    begins = covered.copy()
    begins[1:] &= ~covered[:-1] | first[1:-1]
    ends = covered.copy()
    ends[:-1] &= ~covered[1:] | first[1:-1]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, a, side="right") - 1
    return a - offsets[text], b - offsets[text], text


_FOUND = ("n_words", "spans", "items")
_HITS = [("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]

_FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))]


def _covered_before(column: pa.Array, offsets: np.ndarray, n: int) -> np.ndarray:
    """The hit words that the spans of other parts of the benchmark tell."""
    flat, bounds = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    base = np.repeat(offsets[:-1], np.diff(bounds) // 2)
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, base + flat[::2], 1)
    np.add.at(change, base + flat[1::2], -1)
    return np.cumsum(change[:-1]) > 0


def _lists(values: pa.Array, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _scan(broadcast, schema: pa.Schema, again: bool = False):
    """again: the batches hold what other parts of the benchmark have found. Items are found where the schema has them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = broadcast.value
        ids = pa.array(windows.ids, pa.string())
        for batch in batches:
            for first, last, data, offsets in words.slices(batch.column("text")):
                w = words.split(data, offsets, words.ALNUM, lower=True)
                rows = batch.slice(first, last - first)
                found = windows.find(w)
                covered = found.covered
                if again:
                    covered = covered | _covered_before(rows.column("spans"), w.offsets, len(w.starts))
                a, b, text = spans(covered, w.offsets)
                told = {"n_words": pa.array(w.counts(), pa.int64()), "spans": _lists(pa.array(np.stack([a, b], axis=1).ravel(), pa.int32()), 2 * np.searchsorted(text, np.arange(last - first + 1)))}
                if "items" in schema.names:
                    own = windows.items_by_text(found, last - first)
                    lists = _lists(ids.take(pa.array(np.concatenate([*own, np.zeros(0, np.int32)]))), np.concatenate([[0], np.cumsum([len(x) for x in own])]))
                    if again:
                        lists = pa.array([sorted({*x, *y}) for x, y in zip(lists.to_pylist(), rows.column("items").to_pylist(), strict=True)], pa.list_(pa.string()))
                    told["items"] = lists
                yield pa.RecordBatch.from_arrays([told.get(c) if c in told else rows.column(c) for c in schema.names], schema=schema)

    return scan


def parts_of(benchmark: DataFrame, most: int = BROADCAST_BYTES) -> list[DataFrame]:
    """The distinct items in parts that may be broadcast, each of about `most` bytes of text."""
    benchmark = benchmark.distinct()
    size = benchmark.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // most)
    if n <= 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.filter(part == i) for i in range(n)]


def _items(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    return benchmark.select(F.col(item_column).cast("string").alias("item_id"), F.col(text_column).cast("string").alias("text")).filter("text is not null")


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = N, item_column: str = "item_id", text_column: str = "text", most: int = BROADCAST_BYTES, with_items: bool = True) -> DataFrame:
    """`docs` (a column text, others are kept) with n_words, spans (first word and word after the last of every run
    of hit words, one after the other) and, with_items, items (ids of the items found, sorted)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in _FOUND))
    told = 3 if with_items else 2
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in docs.schema] + _HITS[:told])
    shape = T.StructType([*docs.schema, *_FIELDS[:told]])
    parts = parts_of(_items(benchmark, item_column, text_column), most)
    out = None
    for i, part in enumerate(parts):
        windows = spark.sparkContext.broadcast(Windows(part.toArrow(), n))
        before, out = out, (docs if out is None else out).mapInArrow(_scan(windows, schema, out is not None), shape)
        if i < len(parts) - 1:  # written, so that the next part's windows take the place of these
            out = saved(out, "hits")
            windows.destroy()
        if before is not None and i < len(parts) - 1:
            forget(before)
    return out


def _sha256(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


_REPORT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"]


def _report(broadcast):
    """The report of a benchmark of one part: the digest of a text's items is made once for each set of windows."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = broadcast.value
        digests: dict[int, tuple[np.ndarray, str]] = {}
        for batch in batches:
            for first, last, data, offsets in words.slices(batch.column("text")):
                w = words.split(data, offsets, words.ALNUM, lower=True)
                found = windows.find(w)
                until = np.concatenate([[0], np.cumsum(found.covered)])
                own = windows.items_by_text(found, last - first)
                sha = []
                for x in own:
                    if id(x) not in digests or digests[id(x)][0] is not x:
                        if len(digests) >= 1000:
                            digests.clear()
                        digests[id(x)] = (x, _sha256([windows.ids[i] for i in x.tolist()]))
                    sha.append(digests[id(x)][1])
                arrays = [batch.column("doc_id").slice(first, last - first), pa.array(w.counts(), pa.int64()), pa.array(until[w.offsets[1:]] - until[w.offsets[:-1]], pa.int64()), pa.array([len(x) for x in own], pa.int64()), pa.array(sha, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=_REPORT)

    return report


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = batch.column("items").to_pylist()
        arrays = [batch.column("doc_id"), batch.column("n_words"), batch.column("n_hit"), pa.array(map(len, items), pa.int64()), pa.array(map(_sha256, items), pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=_REPORT)


def report(docs: DataFrame, benchmark: DataFrame, n: int = N, most: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of `docs`."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string"
    parts = parts_of(_items(benchmark), most)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if len(parts) == 1:
        bounded_batches(docs.sparkSession)
        told = docs.mapInArrow(_report(docs.sparkSession.sparkContext.broadcast(Windows(parts[0].toArrow(), n))), shape)
    else:
        told = find_hits(docs, benchmark, n, most=most).select("doc_id", "n_words", hit_words().alias("n_hit"), "items").mapInArrow(_digest, shape)
    return told.withColumn("contaminated", (F.col("n_hit") > 0) & (CONTAMINATED_PART * F.col("n_hit") >= F.col("n_words")))


def hit_words() -> F.Column:
    """The number of words in the runs of the column spans."""
    return F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("sign")), lambda s, x: F.struct((s["n"] + s["sign"] * x).alias("n"), (-s["sign"]).alias("sign")))["n"]


def _aside(docs: DataFrame) -> DataFrame:
    """`docs` with its own columns of the names that find_hits adds put aside."""
    return docs.withColumnsRenamed({c: fresh(docs, f"own_{c}") for c in docs.columns if c in _FOUND})


def _back(docs: DataFrame, found: DataFrame) -> DataFrame:
    return found.select(*(F.col(f"`{fresh(docs, f'own_{c}') if c in _FOUND else c}`").alias(c) for c in docs.columns))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The rows of `docs` that are not contaminated, with their own columns."""
    hits = find_hits(_aside(docs), benchmark, n, with_items=False)
    n_hit = hit_words()
    return _back(docs, hits.filter((n_hit == 0) | (CONTAMINATED_PART * n_hit < F.col("n_words"))))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for (_, _, data, offsets), spans in (
            (s, batch.column("spans")[i].as_py()) for i in range(batch.num_rows) for s in words.slices(batch.column("text").slice(i, 1))
        ):
            w = words.split(data, offsets, words.ALNUM, hashed=False)
            kept, end = [], 0
            for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
                if w.starts[a] > end:
                    kept.append(data[end : w.starts[a]].tobytes())
                end = max(end, int(w.ends[b - 1]))
            kept.append(data[end:].tobytes())
            texts.append(b"".join(kept).decode())
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)


def cut_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """Every row of `docs` with the words inside any occurrence of a window cut out of its text; null texts
    are empty then."""
    hits = find_hits(_aside(docs), benchmark, n, with_items=False)
    return _back(docs, hits.mapInArrow(_cut, hits.schema))


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every row of documents, against the whole benchmark."""
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

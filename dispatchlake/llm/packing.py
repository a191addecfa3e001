"""Best-two-fit packing of tokenized documents into sequences of a fixed length.

A bin is filled greedily, the longest piece that fits first; then its smallest piece is replaced by two
unpacked ones where they fill the gap that it leaves more tightly. What the algorithm decides depends on
lengths alone, so it runs on the histogram of lengths, at most `capacity` numbers however large the corpus:
a bin's lengths are a pattern, which holds for as many bins at once as its lengths allow. The list of
patterns is bounded by `capacity` too and is broadcast. Spark does the rest: texts are tokenized and cut in
tasks that number their pieces by length, the numbers of earlier tasks are added by a sum over (task,
length), and a piece's number within its length tells its pattern, bin and offset.

Lengths are numbered by tasks as they were written, so a lost executor repeats a task of what is not written
yet and nothing else. Null and empty texts have the end token alone. Repeated rows and ids are packed row by
row. A text longer than the capacity is cut into pieces of it, the first of which may be shorter; texts are
encoded whole. An empty table stays empty. Other columns are not needed and may have any name.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .shared import bounded_batches, saved

CAPACITY = 1024
END = 2
#: How a byte-level tokenizer cuts its pre-tokens; a fixed value of its format.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts on which the fast encoder must have the library's ids before it is used.
PROBES = ("", " ", "Hello, it's 2024", "  two \n\n lines\t", "naïve café ﬁ İ ſ", "日本語 テキスト", "a b 　c  d\u0085", "x" * 300, "'S 'll don'T", "½ ² Ⅳ ٣", "🙂🏽 é", "\x00\x1c\x1d \x1f.")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """Ids of texts as the library `tokenizers` gives them for a file, special strings inside texts included.

    For byte-level pair encodings whose merges stand in the order of their ids, the same vocabulary serves
    another encoder that makes nothing but ids; the library has the say on the probes and on every other file.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.fast = self._fast(told)
        if self.fast is not None and any(self.ids(a + s + b) != self._plain(a + s + b) for a in PROBES for b in PROBES[::3] for s in ("", *self.special)):
            self.fast = None

    def _plain(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _fast(self, told: dict):
        pre, model = told.get("pre_tokenizer") or {}, told["model"]
        plain = not told.get("normalizer") and not told.get("post_processor") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        strict = all(not t[k] for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not plain or not strict or (pre.get("type"), model["type"], pre.get("use_regex"), pre.get("add_prefix_space")) != ("ByteLevel", "BPE", True, False):
            return None
        import tiktoken

        printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in printed]
        byte = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special}
        return tiktoken.Encoding("own", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens=self.special)

    def ids(self, text: str) -> list[int]:
        if self.fast is None:
            return self._plain(text)
        if any(s in text for s in self.special):
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; the first piece may be shorter."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


_PIECE = [("part", pa.int32()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("local", pa.int64()), ("ids", pa.list_(pa.int32()))]
_PIECE_SQL = "part int, piece int, start long, length int, ids_crc32 long, local long"


def _pieces(path: str, capacity: int, end: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, numbered = encoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        with_ids = "ids" in schema.names
        for batch in batches:
            rows, out = [], {c: [] for c in schema.names[1:]}
            for row, text in enumerate(batch.column("text")):
                ids = np.array(array("I", encode.ids(text.as_py() or "")), "<u4")
                ids = np.append(ids, np.array([end], "<u4"))
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append(row)
                    values = (part, k, start, length, zlib.crc32(ids[start : start + length]), int(numbered[length]))
                    for name, value in zip(schema.names[1:7], values, strict=True):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(ids[start : start + length].astype(np.int32))
                    numbered[length] += 1
            keys = batch.column("doc_id").take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(out[f.name], f.type) for f in list(schema)[1:])], schema=schema)

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """The pieces of every row of `docs` (doc_id, text), written: with the task that made each (part) and its
    number among the task's pieces of its length (local); with_ids: and the ids."""
    if not 1 <= capacity <= 1 << 20:
        raise ValueError("capacity must lie in 1 to 1,048,576")
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)), *(_PIECE if with_ids else _PIECE[:-1])])
    shape = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_PIECE_SQL + (", ids array<int>" if with_ids else "")).fields])
    return saved(docs.mapInArrow(_pieces(path, capacity, end, schema), shape), "pieces")


class Pattern(NamedTuple):
    """`bins` bins that each hold the lengths of `held`, (length, how many of it) in descending order."""

    held: tuple[tuple[int, int], ...]
    bins: int


def _pair(count: np.ndarray, room: int, over: int) -> tuple[int, int] | None:
    """The two unpacked lengths whose sum is largest within `room` and above `over`, the longer one as long as can be."""
    lengths = np.flatnonzero(count[:room])
    if not len(lengths):
        return None
    most = np.maximum.accumulate(np.where(count > 0, np.arange(len(count)), 0))
    second = most[np.minimum(lengths, room - lengths)]
    alone = (second == lengths) & (count[lengths] < 2)
    second[alone] = most[lengths[alone] - 1]
    sums = np.where(second > 0, lengths + second, 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(lengths[best]), int(second[best])) if sums[best] > over else None


def best_two_fit(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """The patterns in which best-two-fit packs so many pieces of each length."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    patterns = []
    while count.any():
        held: dict[int, int] = {}
        room, tried = capacity, 0
        while room and len(fits := np.flatnonzero(count[1 : room + 1])):
            length = int(fits[-1]) + 1
            held[length] = n = min(int(count[length]), room // length)
            count[length] -= n
            room -= n * length
        smallest = min(held)
        if room and sum(held.values()) > 1 and (pair := _pair(count, room + smallest, smallest)):
            tried = smallest
            held[smallest] -= 1
            count[smallest] += 1
            for length in pair:
                held[length] = held.get(length, 0) + 1
                count[length] -= 1
        held = {length: n for length, n in held.items() if n}
        # the same decisions hold for further bins as long as every length that is put in, or was for a while, is there
        more = min((int(count[length]) - (length == tried)) // n for length, n in held.items())
        if tried and not held.get(tried) and not count[tried]:
            more = 0
        more = max(0, more)
        for length, n in held.items():
            count[length] -= n * more
        patterns.append(Pattern(tuple(sorted(held.items(), reverse=True)), 1 + more))
    return patterns


class Places:
    """Where the piece of a number within its length lies."""

    def __init__(self, patterns: list[Pattern]):
        rows, taken, sequence = [], {}, 0
        for held, bins in patterns:
            offset = 0
            for length, n in held:
                rows.append((length, taken.get(length, 0), sequence, n, offset))
                taken[length] = taken.get(length, 0) + bins * n
                offset += length * n
            sequence += bins
        rows.sort()
        self.sequences = sequence
        self.length, self.first, self.sequence, self.n, self.offset = np.array(rows, np.int64).reshape(-1, 5).T
        self.bounds = np.searchsorted(self.length, np.arange(int(self.length.max(initial=0)) + 2))

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for k in np.unique(length).tolist():
            own = np.flatnonzero(length == k)
            a, b = self.bounds[k], self.bounds[k + 1]
            at = a + np.searchsorted(self.first[a:b], number[own], side="right") - 1
            past = number[own] - self.first[at]
            sequence[own] = self.sequence[at] + past // self.n[at]
            offset[own] = self.offset[at] + past % self.n[at] * k
        return sequence, offset


def _place(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = broadcast.value.find(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            names = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return run


def pack(cut_up: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """What `pieces` has written, with sequence_id and offset of every piece."""
    spark = cut_up.sparkSession
    counts = cut_up.groupBy("part", "length").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r[0]: r[1] for r in cut_up.groupBy("length").count().collect()}  # at most `capacity` rows
    places = spark.sparkContext.broadcast(Places(best_two_fit(histogram, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = cut_up.join(before, ["part", "length"]).withColumn("number", F.col("local") + F.col("_before")).drop("part", "local", "_before")
    shape = T.StructType([f for f in numbered.schema if f.name != "number"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(_place(places), shape)


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and doc_ids and lengths of the pieces in their order.
    A sequence is at most `capacity` pieces, so its group is small whatever the corpus."""
    packed = pack(pieces(docs, path, capacity, end, with_ids=True), capacity)
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths")
    )


def op12_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every piece of documents."""
    packed = pack(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path()))
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")

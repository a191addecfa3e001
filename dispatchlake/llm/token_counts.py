"""Token counts of whole texts without materialising ids.

The pieces of a pre-token are counted once for each distinct pre-token of the corpus. White space ends
every pre-token of the tokenizer and never joins with what follows (nor do its special strings hold
any), so a text's words are the unit in which pre-tokens are carried: distinct words are cut into their
pre-tokens by the tokenizer's own normalizer and pre-tokenizer, distinct pre-tokens are counted by its
model, the counts are joined back and summed for each word, and each document's word frequencies meet
the words' counts.

The counts of the most frequent words, at most BROADCAST_WORDS of them, are broadcast; the words
beyond that are joined by a shuffle, already summed for each document. Words meet their counts by a
64-bit hash of their bytes. A tokenizer for which white space does not end pre-tokens is refused.

Null and empty texts have 0 tokens. Repeated rows, null and repeated ids are counted row by row. Very long
texts are counted whole; an empty table stays empty. Other columns are not needed and may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import words
from .shared import bounded_batches, parts, saved, text_bytes

BROADCAST_WORDS = 2_000_000
#: What ends a word.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
OVER = 2048
#: Distinct words that a task holds before it sends them: at most so many, of at most so many bytes together.
FLUSH_WORDS = 400_000
FLUSH_BYTES = 64 << 20


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class PreTokens:
    """A word's pre-tokens and a pre-token's number of pieces, as the library has them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = frozenset(special)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def of(self, word: str) -> list[str]:
        out = []
        for part in self.cut.split(word) if self.cut and any(s in word for s in self.special) else [word]:
            if part in self.special:
                out.append(part)
            elif part:
                clean = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                out += [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(clean)]
        return out

    def pieces(self, pre_token: str) -> int:
        return 1 if pre_token in self.special else len(self.tokenizer.model.tokenize(pre_token))

    def verify(self) -> None:
        """Raises unless texts of several words have the tokens of their words: with every kind of white space
        that ends words here, alone and repeated, beside letters, digits, signs and special strings."""
        if any(set(s) & set(SPACE) for s in self.special):
            raise ValueError("a special string of the tokenizer holds white space")
        sides = ["word", "Word", "don't", "12", "3.5", ",", "--", "(a", "é", "日本", *self.special]
        texts = [f"{a}{gap}{b}" for gap in (*SPACE, "  ", " \n", "\n\n\n", "\t ") for a in sides for b in sides]
        texts += [f"{gap}{a}{gap}" for gap in (" ", "\n", "  ") for a in sides]
        for text in texts:
            whole = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
            if whole != sum(self.pieces(p) for word in re.split(f"[{SPACE}]+", text) if word for p in self.of(word)):
                raise ValueError(f"white space does not end pre-tokens of this tokenizer: {text!r}")


def _distinct(slices: int):
    """Each distinct word of a partition and how often it occurs, packed by slices of its hash."""
    schema = pa.schema([("slice", pa.int32()), ("words", pa.binary()), ("times", pa.binary())])

    def flush(held: dict[int, list]) -> pa.RecordBatch:
        by: dict[int, list] = {}
        for h, entry in held.items():
            by.setdefault((h >> 32) * slices >> 32, []).append(entry)
        keys = sorted(by)
        return pa.RecordBatch.from_pydict(
            {"slice": keys, "words": [b"\n".join(w for w, _ in by[k]) for k in keys], "times": [np.array([n for _, n in by[k]], "<u8").tobytes() for k in keys]},
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            for _, _, data, offsets in words.slices(batch.column("text")):
                w = words.split(data, offsets)
                found, at, times = np.unique(w.hashes, return_index=True, return_counts=True)
                raw = data.tobytes()
                for h, s, e, n in zip(found.tolist(), w.starts[at].tolist(), w.ends[at].tolist(), times.tolist(), strict=True):
                    if h in held:
                        held[h][1] += n
                    else:
                        held[h] = [raw[s:e], n]
                        size += e - s
                    if size >= FLUSH_BYTES:
                        yield flush(held)
                        held, size = {}, 0
                if len(held) >= FLUSH_WORDS:
                    yield flush(held)
                    held, size = {}, 0
        if held:
            yield flush(held)

    return run


def _united(path: str):
    """The distinct words of a slice: hash, how often, pre-tokens."""
    schema = pa.schema([("word", pa.int64()), ("times", pa.int64()), ("pre_tokens", pa.list_(pa.string()))])

    def unite(key: tuple, table: pa.Table) -> pa.Table:
        pre_tokens = PreTokens(path)
        data = np.frombuffer(b"\n".join(table.column("words").to_pylist()), np.uint8)
        w = words.split(data, np.array([0, len(data)]))
        times = np.concatenate([np.frombuffer(t, "<u8") for t in table.column("times").to_pylist()]).astype(np.int64)
        found, at, rank = np.unique(w.hashes, return_index=True, return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, rank, times)
        lists = [pre_tokens.of(w.word(i).decode()) for i in at.tolist()]
        return pa.Table.from_arrays([pa.array(found.view(np.int64)), pa.array(total), pa.array(lists, pa.list_(pa.string()))], schema=schema)

    return unite


def _counted(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre_tokens = PreTokens(path)
        for batch in batches:
            n = [pre_tokens.pieces(p) for p in batch.column("pre_token").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("pre_token"), pa.array(n, pa.int32())], names=["pre_token", "pieces"])

    return count


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """word (hash), times and n_tokens of every distinct word of the column text."""
    spark = docs.sparkSession
    slices = parts(spark, text_bytes(docs), least=2)
    packed = docs.select("text").mapInArrow(_distinct(slices), "slice int, words binary, times binary")
    united = saved(packed.groupBy("slice").applyInArrow(_united(path), "word long, times long, pre_tokens array<string>"), "token-words")
    each = united.select("word", "times", F.explode_outer("pre_tokens").alias("pre_token"))
    pieces = each.select("pre_token").distinct().filter("pre_token is not null").mapInArrow(_counted(path), "pre_token string, pieces int")
    joined = each.join(pieces, "pre_token", "left").groupBy("word").agg(F.first("times").alias("times"), F.coalesce(F.sum("pieces"), F.lit(0)).alias("n_tokens"))
    return saved(joined, "token-counts")


class Table:
    """Counts by word hash, for many at once."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]

    def prepare(self) -> None:
        self.bits = max(10, int(np.ceil(np.log2(len(self.hashes) + 1))) + 1)
        self.first = np.zeros(1 << self.bits, np.int32)
        self.first[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)[::-1]] = np.arange(len(self.hashes), dtype=np.int32)[::-1]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, whether known) of each."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), dtype=bool)
        at = self.first[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)]
        known = self.hashes[at] == hashes
        rest = np.flatnonzero(~known)
        if len(rest):
            at[rest] = np.minimum(np.searchsorted(self.hashes, hashes[rest]), len(self.hashes) - 1)
            known[rest] = self.hashes[at[rest]] == hashes[rest]
        return np.where(known, self.counts[at], 0), known


def _summed(broadcast, schema: pa.Schema):
    rest_type = pa.list_(pa.struct([("word", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Table = broadcast.value
        table.prepare()
        for batch in batches:
            for first, last, data, offsets in words.slices(batch.column("text")):
                w = words.split(data, offsets)
                counts, known = table.find(w.hashes)
                until = np.concatenate([[0], np.cumsum(counts)])
                tokens = until[w.offsets[1:]] - until[w.offsets[:-1]]
                rest: list[list] = [[] for _ in range(last - first)]
                unknown = np.flatnonzero(~known)
                if len(unknown):
                    text = np.searchsorted(w.offsets, unknown, side="right") - 1
                    for t in np.unique(text).tolist():
                        h, n = np.unique(w.hashes[unknown[text == t]], return_counts=True)
                        rest[t] = [{"word": a, "times": b} for a, b in zip(h.view(np.int64).tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(np.diff(offsets)), pa.array(tokens.astype(np.int64)), pa.array(rest, rest_type)], schema=schema)

    return run


def count_tokens(docs: DataFrame, path: str, most: int = BROADCAST_WORDS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    PreTokens(path).verify()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counts = word_counts(docs, path)
    magnitudes = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("times")).cast("int")).count().collect()}
    least, room = max(magnitudes, default=0) + 1, most
    while least > 0 and magnitudes.get(least - 1, 0) <= room:
        least -= 1
        room -= magnitudes.get(least, 0)
    head = counts.filter(F.floor(F.log2("times")) >= least).select("word", "n_tokens").toArrow()
    table = spark.sparkContext.broadcast(Table(head.column("word").to_numpy().view(np.uint64), head.column("n_tokens").to_numpy().astype(np.int32)))
    del head
    id_type = docs.schema["doc_id"].dataType
    rest = "rest array<struct<word: long, times: long>>"
    schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("rest", pa.list_(pa.struct([("word", pa.int64()), ("times", pa.int64())])))])
    summed = docs.mapInArrow(_summed(table, schema), f"doc_id {id_type.simpleString()}, n_bytes long, n_tokens long, {rest}")
    if least > 0:  # the words that are not broadcast
        summed = saved(summed.withColumn("_row", F.monotonically_increasing_id()), "token-sums")
        tail = counts.filter(F.floor(F.log2("times")) < least).select("word", F.col("n_tokens").alias("pieces"))
        more = summed.select("_row", F.inline("rest")).join(tail, "word").groupBy("_row").agg(F.sum(F.col("times") * F.col("pieces")).alias("_more"))
        summed = summed.join(more, "_row", "left").withColumn("n_tokens", F.col("n_tokens") + F.coalesce("_more", F.lit(0)))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > OVER).alias("over_limit"))


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every row of documents."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())

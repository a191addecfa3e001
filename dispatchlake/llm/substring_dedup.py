"""Substring deduplication: words in passages that occur again anywhere go.

A window is WINDOW consecutive words of one text. Every word that is covered by a window whose word
sequence also starts anywhere else (in another text or the same one) is removed; all windows are
judged on the input.

1. Every partition fills a count-min sketch and the sketches are merged. A window is counted through
   the rarest-hash 16-word sequence inside it (its anchor): equal windows have equal anchors at
   different places, so the anchor's count is never below the window's, and anchors are a tenth as
   many as windows.
2. Only windows whose estimate is two or more are grouped exactly, by 128 bits of hash. Texts lie in
   blocks; a block sends each of its candidate windows once, sorted, to the slice that the hash
   belongs to, and gets one bit for each back. A window that a third of all texts hold is so sent
   once for each block, and no group holds its places.
3. The block marks the covered words.

Nulls and empty texts have no words and are returned with zeros. Rows are judged as they stand: a
repeated row is an exact copy, so all its words go if it has a window. The input's other columns are
not needed and may have any name. Null and repeated ids are rows of their own; rows lie in blocks by id
and text, so only rows equal in both share one. Very long texts are judged whole; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch, words
from .shared import bounded_batches, parts, text_bytes

WINDOW = 35
ANCHOR = 16
ROWS = 2
#: Bytes of text for an anchor, about.
ANCHOR_BYTES = 50

RESULT = "doc_id {id}, n_words long, n_removed long, kept_sha256 string"
RESULT_TEXT = RESULT + ", kept_text string"


def _anchors(hashes: np.ndarray, valid: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Each window's least hash of a short sequence inside it, and those hashes once for each place."""
    k = min(ANCHOR, window)
    width = window - k + 1
    grams = words.ngrams(hashes, k, words.BASES[1])
    if len(grams) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    least = words.sliding(grams, width, np.minimum)
    shown = np.where(valid[: len(least)], least, np.uint64(0))
    # a place is an anchor if its hash is the least of any valid window around it
    padded = np.concatenate([np.zeros(width - 1, np.uint64), shown, np.zeros(width - 1, np.uint64)])
    around = words.sliding(padded, width, np.maximum)
    return least, grams[(around == grams) & (grams != 0)]


def _sketched(window: int):
    def values(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, offsets in words.slices(batch.column("text")):
            found = words.split(data, offsets)
            yield _anchors(found.hashes, found.valid(window), window)[1]

    return values


class _Block:
    """The candidate windows of a block of texts: where they are, and each of their hashes once, in order."""

    def __init__(self, table: pa.Table, window: int, estimates: sketch.Sketch, slices: int):
        self.pieces = []
        one, two = [], []
        for first, last, data, offsets in words.slices(table.column("text")):
            found = words.split(data, offsets)
            valid = found.valid(window)
            least, _ = _anchors(found.hashes, valid, window)
            at = np.flatnonzero(valid[: len(least)])
            at = at[estimates.at_least_two(least[at])]
            self.pieces.append((first, last, data, offsets, found.offsets, at))
            one.append(words.ngrams(found.hashes, window, words.BASES[0])[at])
            two.append(words.ngrams(found.hashes, window, words.BASES[1])[at])
        one = np.concatenate(one) if one else np.zeros(0, np.uint64)
        two = np.concatenate(two) if two else np.zeros(0, np.uint64)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.ones(len(one), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        rank = np.cumsum(new) - 1
        self.one, self.two = one[new], two[new]
        self.times = np.bincount(rank, minlength=len(self.one)) if len(rank) else np.zeros(0, np.int64)
        self.rank = np.empty(len(rank), np.int64)
        self.rank[order] = rank
        self.slice = ((self.one >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


_ASKED = pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("one", pa.binary()), ("two", pa.binary())])
_TOLD = pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("n", pa.int64()), ("repeated", pa.binary())])


def _ask(window: int, estimates, slices: int):
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(table, window, estimates.value, slices)
        found, at = np.unique(block.slice, return_index=True)
        ends = [*at[1:].tolist(), len(block.slice)][: len(at)]
        spans = list(zip(at.tolist(), ends, strict=True))
        return pa.Table.from_pydict(
            {
                "block": [key[0].as_py()] * len(spans),
                "slice": found.tolist(),
                "one": [block.one[a:b].tobytes() for a, b in spans],
                "two": [block.two[a:b].tobytes() for a, b in spans],
            },
            schema=_ASKED,
        )

    return ask


def _tell(key: tuple, table: pa.Table) -> pa.Table:
    """For every block's windows of a slice, whether another block has them too."""
    ones = [np.frombuffer(x, np.uint64) for x in table.column("one").to_pylist()]
    one = np.concatenate(ones)
    two = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("two").to_pylist()])
    order = np.lexsort((two, one))
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    twice = np.zeros(len(one) + 1, dtype=bool)
    twice[1:-1] |= same
    twice[:-2] |= same
    repeated = np.empty(len(one), dtype=bool)
    repeated[order] = twice[:-1]
    ends = np.cumsum([len(x) for x in ones])
    return pa.Table.from_pydict(
        {
            "block": table.column("block").to_pylist(),
            "slice": table.column("slice").to_pylist(),
            "n": [len(x) for x in ones],
            "repeated": [np.packbits(x).tobytes() for x in np.split(repeated, ends[:-1])],
        },
        schema=_TOLD,
    )


def _mark(window: int, estimates, slices: int, texts: bool, id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    if texts:
        schema = schema.append(pa.field("kept_text", pa.string()))

    def mark(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        block = _Block(table, window, estimates.value, slices)
        repeated = block.times > 1
        if told.num_rows:
            told = told.sort_by("slice")
            repeated |= np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(told.column("repeated").to_pylist(), told.column("n").to_pylist(), strict=True)])
        hit = repeated[block.rank]
        n_words, n_removed, digests, kept_texts, used = [], [], [], [], 0
        for _, _, data, offsets, word_offsets, at in block.pieces:
            hits = at[hit[used : used + len(at)]]
            used += len(at)
            cover = np.zeros(int(word_offsets[-1]) + window + 1, np.int32)
            cover[hits] += 1
            cover[hits + window] -= 1
            kept = (np.cumsum(cover) == 0).tobytes()
            raw = data.tobytes()
            for i in range(len(offsets) - 1):
                a, b = int(word_offsets[i]), int(word_offsets[i + 1])
                keep = kept[a:b]
                text = b" ".join(compress(raw[offsets[i] : offsets[i + 1]].split(), keep))
                n_words.append(b - a)
                n_removed.append(keep.count(0))
                digests.append(hashlib.sha256(text).hexdigest())
                if texts:
                    kept_texts.append(text.decode())
        columns = [table.column("doc_id").combine_chunks().cast(id_type), n_words, n_removed, digests] + ([kept_texts] if texts else [])
        return pa.Table.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return mark


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, texts: bool = True) -> DataFrame:
    """One row for each row of `docs`: its id as doc_id, n_words, n_removed, kept_sha256 and, unless
    `texts` is false, kept_text (the kept words, joined by one space)."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    bounded_batches(spark)
    only = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    size = text_bytes(only)
    bits = sketch.bits_for(size / ANCHOR_BYTES, ROWS)
    filled = only.select("text").mapInArrow(sketch.filler(_sketched(window), ROWS, bits), sketch.EMITTED)
    estimates = spark.sparkContext.broadcast(sketch.gather(filled, ROWS, bits))
    # a block sends each slice one row: their numbers multiply until a row holds a single window, then rows are
    # as many as candidate windows; both stay near what keeps all tasks busy
    blocks, slices = parts(spark, size, least=2), parts(spark, size * 3, least=1)
    blocked = only.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    asked = blocked.groupBy("block").applyInArrow(_ask(window, estimates, slices), "block long, slice long, one binary, two binary")
    told = asked.groupBy("slice").applyInArrow(_tell, "block long, slice long, n long, repeated binary")
    id_type = only.schema["doc_id"].dataType
    result = (RESULT_TEXT if texts else RESULT).format(id=id_type.simpleString())
    return blocked.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_mark(window, estimates, slices, texts, to_arrow_type(id_type)), result)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of documents."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)

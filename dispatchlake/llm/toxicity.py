"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, word pairs, and pairs with one word between, lower-cased
(A-Z), each hashed to one of 2**BITS coordinates. Every coordinate has its own learning rate and an
L1 penalty keeps weights at zero until a coordinate has earned one, so the weights that are broadcast
are few; all of them are kept, at most 2**BITS (16 MB).

Training takes at most `sample` labelled rows, chosen by hashes: a documented bound that does not grow
with the corpus. The bound is on rows, not ids: of an id that many rows hold, and of all rows together,
only so many are drawn, and rows equal in id and text teach once. Their features are made where the
rows lie; the gradient steps, which follow one another, run over the sample in one task (averaging the
states of several shards instead lost a fifth of the toxic rows that are found). Scoring runs over every
whole text of the table.

Rows whose crc32(id as text) mod FOLDS is 0 are held out of training; a null id counts as the empty text,
so rows without an id are held out. Null and empty texts have the intercept's score. Rows with a null
label, and labels without a row, teach nothing; an id with several labels counts as 1 if any is. Without
usable labels every score is 0.5 or below and nothing is predicted. An empty table stays empty. Repeated
rows have equal scores. Labels, lang, source and doc_id are never features; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import words
from .shared import bounded_batches, fresh

BITS = 22
FOLDS = 5
SAMPLE = 12_000
#: Of the rows that teach: about so many bytes of text together, or the longest one's.
SAMPLE_BYTES = 256 << 20
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.1
#: What an error on a toxic row counts, an error on another being 1: toxic rows are few.
TOXIC_COST = 2.0
_SKIP = np.uint64(0x2545F4914F6CDD1D)


def features(w: words.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(coordinate, text) of every feature of some texts, with repeats."""
    text = np.repeat(np.arange(len(w.offsets) - 1), w.counts())
    h = w.hashes
    shift = np.uint64(64 - BITS)
    yield (words.mix(h) >> shift).astype(np.uint32), text
    if len(h) > 1:
        pair = words.mix(h[:-1] * np.uint64(words.BASES[0]) + h[1:])
        same = text[:-1] == text[1:]
        yield (pair[same] >> shift).astype(np.uint32), text[:-1][same]
    if len(h) > 2:
        skip = words.mix((h[:-2] ^ _SKIP) * np.uint64(words.BASES[1]) + h[2:])
        same = text[:-2] == text[2:]
        yield (skip[same] >> shift).astype(np.uint32), text[:-2][same]


def _words(data: np.ndarray, offsets: np.ndarray) -> words.Words:
    return words.split(data, offsets, words.ALNUM, lower=True)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for first, last, data, offsets in words.slices(batch.column("text")):
            found = list(features(_words(data, offsets)))
            text = np.concatenate([t for _, t in found])
            each = np.unique(text.astype(np.uint64) << np.uint64(32) | np.concatenate([c for c, _ in found]))
            ends = np.searchsorted(each, np.arange(1, last - first) << 32)
            packed += [x.astype("<u4").tobytes() for x in np.split(each, ends)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("toxic"), pa.array(packed, pa.binary())], names=["key", "toxic", "features"])


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)).astype(np.float32)


def _fitted(key: tuple, table: pa.Table) -> pa.Table:
    """The weights after EPOCHS passes over the sample, each in its own fixed order. The intercept is the
    coordinate -1 and has no L1 penalty."""
    z, n = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
    z0 = n0 = 0.0
    rows = sorted(zip(table.column("key").to_pylist(), table.column("toxic").to_pylist(), table.column("features").to_pylist(), strict=True))
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            _, label, packed = rows[i]
            at = np.frombuffer(packed, "<u4")
            zi, ni = z[at], n[at]
            w = _weights(zi, ni)
            b = -z0 / ((BETA + n0**0.5) / ALPHA + L2)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = np.float32((p - label) * (TOXIC_COST if label else 1))
            root = np.sqrt(ni + g * g)
            z[at] = zi + g - (root - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
            z0, n0 = z0 + g - ((n0 + g * g) ** 0.5 - n0**0.5) / ALPHA * b, n0 + g * g
    w = _weights(z, n)
    at = np.flatnonzero(w)
    bias = -z0 / ((BETA + n0**0.5) / ALPHA + L2)
    return pa.table({"coordinate": pa.array([-1, *at.tolist()], pa.int32()), "weight": pa.array([bias, *w[at].tolist()], pa.float64())})


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def drawn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """key, toxic and features of the rows that teach, `sample` at most, of about SAMPLE_BYTES of text together. Ids are
    compared and drawn as texts, whatever their types are on both sides."""
    usable = labels.select(F.col("doc_id").cast("string").alias("doc_id"), "toxic").filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    below = lambda key, share: F.shiftrightunsigned(key, 32) < int(share * (1 << 32))
    share = min(1.0, sample / max(1, usable.count()))
    some = lambda df: df.filter(below(F.xxhash64("doc_id"), share))
    rows, key = some(docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))), F.xxhash64("doc_id", "text")
    # an id may stand for any number of rows: those that differ are counted and drawn too
    held = rows.join(F.broadcast(some(usable)), "doc_id", "left_semi")
    differ, size = held.agg(F.approx_count_distinct(key), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    rows = rows.filter(below(F.xxhash64(key), min(1.0, sample / max(1, differ), SAMPLE_BYTES / max(1, size))))
    rows = rows.join(some(usable), "doc_id").select(key.alias("key"), F.col("toxic").cast("int").alias("toxic"), "text")
    found = rows.mapInArrow(_featured, "key long, toxic int, features binary")
    once = found.groupBy("key").agg(F.max("toxic").alias("toxic"), F.first("features").alias("features"))
    return once.orderBy("key").limit(sample)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, intercept) learnt from the labelled rows that are not held out."""
    bounded_batches(docs.sparkSession)
    # the sample is bounded, so one task may hold it
    found = drawn(docs, labels, sample).groupBy(F.lit(0).alias("all")).applyInArrow(_fitted, "coordinate int, weight double").toArrow()
    at, weight = found.column("coordinate").to_numpy(), found.column("weight").to_numpy()
    bias = weight[at < 0]
    return at[at >= 0].astype(np.uint32), weight[at >= 0].astype(np.float32), float(bias[0]) if len(bias) else -1.0


def _scorer(model, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, weight, bias = model.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = weight
        for batch in batches:
            scores = []
            for first, last, data, offsets in words.slices(batch.column("text")):
                keys = []
                for coordinate, text in features(_words(data, offsets)):
                    hit = np.flatnonzero(dense[coordinate])
                    keys.append(text[hit].astype(np.uint64) << np.uint64(32) | coordinate[hit])
                once = np.unique(np.concatenate(keys))
                total = np.bincount((once >> np.uint64(32)).astype(np.int64), dense[(once & np.uint64(0xFFFFFFFF)).astype(np.int64)], last - first)
                scores.append(1 / (1 + np.exp(-np.clip(total + bias, -35, 35))))
            score = np.concatenate(scores) if scores else np.zeros(0)
            kept = [batch.column(c) for c in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64())], schema=schema)

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], column: str = "score") -> DataFrame:
    """`docs` with the score of each row's text in `column` (a column of this name is replaced)."""
    from pyspark.sql import types as T

    docs = docs.drop(column)
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in docs.schema), (column, pa.float64())])
    return docs.mapInArrow(_scorer(sent, schema), T.StructType([*docs.schema, T.StructField(column, T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose text is not predicted to be toxic, with their own columns, whatever their names."""
    column = fresh(docs, "toxicity")
    scored = score(docs, train(docs, labels), column)
    return scored.filter(F.col(column) < 0.5).select(*(F.col(f"`{c}`") for c in docs.columns))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""How far the sources of each language lie apart in the words they use: a heavy-light split.

Every (lang, source) group has a smoothed share p of each term that its language keeps, in whole parts of
10^9, and two groups lie sum |p - p'| apart. Terms that more than a third of a language's groups hold are
heavy: their shares are laid out as dense tiles of groups by terms, and numpy sums the differences of two
tiles. The other terms are light. For them every pair starts from the distance that it has if it holds none
of them, the shares of the one side against the other's empty share are added from a histogram of shares,
and a pair that meets in a term's posting list is corrected for having met there. All sums are of integers,
so the parts add up exactly, in any order.

Tasks count terms with bounded memory and send sums by group and term; only kept terms go on. Postings lie
in blocks by the hash of the term, tiles in blocks of terms and pairs of tiles, so no language, group or
term is one task's work; a task sends one sum for each pair it has met, never the pairs themselves. The
answer has a row for each two sources of a language, which bounds the number of sources that make sense.

Null texts, languages and sources are ''. Groups without kept terms take part with empty shares; a
language that keeps no term has distances of 0. Repeated rows count as often as they stand there; texts are
counted whole; an empty table gives no rows. Other columns are not needed and may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bounded_batches, forget, saved

LEAST_DOCS = 30
TOP = 50
ADDED = 5
PARTS = 1_000_000_000
#: A term in more than 1 / HEAVY of its language's groups is heavy.
HEAVY = 3
#: Groups of a tile, and about how many terms a block of tiles has, postings a block of them.
TILE = 64
BLOCK_TERMS = 4096
BLOCK_POSTINGS = 200_000
#: A task's counts are sent on beyond so many entries or so many bytes of text.
FLUSH_ENTRIES = 400_000
FLUSH_BYTES = 64 << 20

#: Bytes that separate terms become spaces, A-Z small letters.
_TERMS = bytes(32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if b <= 0x5A else b for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _sent(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    """A row for each group and term, and one without a term for each group."""
    for (lang, source), (times, docs) in held.items():
        terms = [None, *times]
        for a in range(0, len(terms), 50_000):
            own = terms[a : a + 50_000]
            arrays = [[lang] * len(own), [source] * len(own), pa.array(own, pa.binary()).cast(pa.string()), [times[t] for t in own], [docs[t] for t in own]]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(arrays, _COUNTS, strict=True)], schema=_COUNTS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = seen = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            raw, before = text.as_py(), len(times)
            terms = raw.translate(_TERMS).split()
            times.update(terms)
            docs.update(set(terms))
            entries += len(times) - before
            seen += len(raw)
            if entries > FLUSH_ENTRIES or seen > FLUSH_BYTES:
                yield from _sent(held)
                held, entries, seen = {}, 0, 0
    yield from _sent(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs of each group's terms, and a row with a null term for each group."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counted = docs.select(text("lang"), text("source"), text("text")).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str = "total") -> F.Column:
    """The share of a term with `n` occurrences where all `kept` terms have `total` of them."""
    return F.expr(f"1 + (cast({PARTS} as decimal(38, 0)) * ({n} + {ADDED})) div ({total} + {ADDED} * kept)")


class Audit:
    """What both parts of the answer are made of, written once: groups, and the kept terms of each."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        bounded_batches(docs.sparkSession)
        counts = saved(term_counts(docs), "term-counts")
        by_lang = counts.filter("term is not null").groupBy("lang", "term")
        kept = saved(by_lang.agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"), F.count(F.lit(1)).alias("spread")).filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("total_lang"))
        sizes = counts.filter("term is null").select("lang", "source").withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        sizes = sizes.join(sizes.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")), "lang").join(langs, "lang", "left")
        held = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang", "spread")
        totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = sizes.join(totals, ["lang", "source"], "left").fillna(0, ["total", "kept", "total_lang"])
        #: lang, source, i (its number within lang), groups (of lang), kept (terms of lang), total, empty (the share of a term that it lacks)
        self.groups = saved(groups.withColumn("empty", F.when(F.col("kept") > 0, share("0")).otherwise(F.lit(0).cast("long"))), "groups")
        #: one row for each kept term that a group holds
        self.held = saved(held.join(self.groups, ["lang", "source"]).select("*", share("n").alias("p")), "held-terms")
        forget(counts, kept)

    def terms(self, top: int = TOP) -> DataFrame:
        """The terms that each group uses more than its language does: lang, source, item, value, rank."""
        of_lang = share("n_lang", "total_lang")
        over = self.held.select("lang", "source", F.col("term").alias("item"), (F.col("p") - of_lang).alias("value")).filter("value > 0")
        return ranked(over).filter(F.col("rank") <= top)

    def pairs(self) -> DataFrame:
        """How far apart each two groups of a language lie, in both directions: lang, source, item, value, rank."""
        sums = self._apart().groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = sums.select("lang", "a", "b", "value").union(sums.select("lang", "b", "a", "value"))
        name = lambda i, n: self.groups.select("lang", F.col("i").alias(i), F.col("source").alias(n))
        return ranked(both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select("lang", "source", "item", "value"))

    def _apart(self) -> DataFrame:
        heavy = F.col("spread") * HEAVY > F.col("groups")
        terms = {r[0]: r[1] for r in self.held.groupBy(heavy.alias("heavy")).count().collect()}
        light = self.held.filter(~heavy)
        postings = light.select("lang", _block("term", terms.get(False, 0), BLOCK_POSTINGS).alias("block"), "term", F.col("i").cast("long"), "p", "empty")
        met = postings.groupBy("lang", "block").applyInArrow(_met, _SUMS)

        histogram = light.groupBy("lang", "i", "p").agg(F.count(F.lit(1)).alias("n")).join(self.groups.select("lang", "i", "groups"), ["lang", "i"])
        light_terms = light.groupBy("lang").agg(F.count_distinct("term").alias("light"))
        empty = self.groups.join(light_terms, "lang", "left").select("lang", "i", "groups", F.lit(None).cast("long").alias("p"), F.coalesce("light", F.lit(0)).alias("n"), "empty")
        start = _tiled(empty.unionByName(histogram.withColumn("empty", F.lit(None).cast("long")))).groupBy("lang", "x", "y").applyInArrow(_without, _SUMS)

        blocks = max(1, -(-terms.get(True, 0) // BLOCK_TERMS))
        block = _block("term", terms.get(True, 0), BLOCK_TERMS)
        dense = self.held.filter(heavy).select("lang", block.alias("block"), "term", "i", "groups", "p", F.lit(None).cast("long").alias("empty"))
        marks = self.groups.filter("kept > 0").select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("string").alias("term"), "i", "groups", F.lit(None).cast("long").alias("p"), "empty")
        tiles = _tiled(dense.unionByName(marks)).groupBy("lang", "x", "y", "block").applyInArrow(_dense, _SUMS)
        return met.unionByName(start).unionByName(tiles)


def _block(term: str, rows: int, size: int) -> F.Column:
    return F.pmod(F.xxhash64(term), F.lit(max(1, -(-rows // size)))).cast("int")


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows of groups, once for every pair of tiles x <= y that the group's tile is in."""
    own, other = F.floor(F.col("i") / TILE), F.explode(F.sequence(F.lit(0), F.floor((F.col("groups") - 1) / TILE).cast("int")))
    tiles = rows.withColumn("_own", own.cast("int")).withColumn("_other", other)
    return tiles.select("*", F.least("_own", "_other").alias("x"), F.greatest("_own", "_other").alias("y"), F.col("i").cast("long").alias("g")).drop("_own", "_other", "groups", "i")


_SUMS = "lang string, a long, b long, value long"


def _table(lang: str, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pa.Table:
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "value": pa.array(value, pa.int64())})


def _summed(a: np.ndarray, b: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each a, b."""
    order = np.lexsort((b, a))
    a, b, value = a[order], b[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], np.add.reduceat(value, first) if len(first) else value


def _met(key: tuple, table: pa.Table) -> pa.Table:
    """What the pairs that meet in the posting lists of a block are to be corrected by."""
    rank = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    i, p, empty = (table.column(c).to_numpy() for c in ("i", "p", "empty"))
    order = np.lexsort((i, rank))
    rank, i, p, empty = rank[order], i[order], p[order], empty[order]
    sums, held, step = [], 0, 1
    while step < len(rank) and (at := np.flatnonzero(rank[step:] == rank[:-step])).size:
        u, v = at, at + step
        value = np.abs(p[u] - p[v]) - np.abs(p[u] - empty[v]) - np.abs(empty[u] - p[v]) + np.abs(empty[u] - empty[v])
        sums.append(_summed(i[u], i[v], value))
        held += len(sums[-1][0])
        if held > 1_000_000:
            sums = [_summed(*(np.concatenate(x) for x in zip(*sums, strict=True)))]
            held = len(sums[0][0]) // 2
        step += 1
    if not sums:
        return _table(key[0].as_py(), *(np.zeros(0, np.int64),) * 3)
    return _table(key[0].as_py(), *_summed(*(np.concatenate(x) for x in zip(*sums, strict=True))))


def _pairs_of(x: np.ndarray, y: np.ndarray, same: bool) -> np.ndarray:
    """Which cells of the tiles x by y are pairs a < b."""
    return x[:, None] < y[None, :] if same else np.ones((len(x), len(y)), dtype=bool)


def _sides(g: np.ndarray, x: int, y: int) -> tuple[np.ndarray, np.ndarray]:
    return g[g // TILE == x], g[g // TILE == y]


def _without(key: tuple, table: pa.Table) -> pa.Table:
    """The light terms' part of each pair, as if no two groups met in any."""
    lang, x, y = (k.as_py() for k in key)
    g, p, n, empty = (table.column(c).combine_chunks() for c in ("g", "p", "n", "empty"))
    marks = empty.is_valid().to_numpy(zero_copy_only=False)
    groups, g = g.to_numpy()[marks], g.to_numpy()
    order = np.argsort(groups)
    groups, bare, light = groups[order], empty.drop_null().to_numpy()[order], n.to_numpy()[marks].max(initial=0)
    p, n, of = p.drop_null().to_numpy(), n.to_numpy()[~marks], np.searchsorted(groups, g[~marks])
    order = np.lexsort((p, of))
    p, n, bounds = p[order], n[order], np.searchsorted(of[order], np.arange(len(groups) + 1))
    one = np.zeros((len(groups), len(groups)), np.int64)  # the row's terms against the column's empty share
    for k in range(len(groups)):
        own, times = p[bounds[k] : bounds[k + 1]], n[bounds[k] : bounds[k + 1]]
        many, mass = np.concatenate([[0], np.cumsum(times)]), np.concatenate([[0], np.cumsum(times * own)])
        below = np.searchsorted(own, bare)
        one[k] = bare * (2 * many[below] - many[-1]) - 2 * mass[below] + mass[-1] - many[-1] * np.abs(bare - bare[k])
    whole = light * np.abs(bare[:, None] - bare[None, :]) + one + one.T
    a, b = _sides(groups, x, y)
    whole = whole[np.ix_(np.searchsorted(groups, a), np.searchsorted(groups, b))]
    u, v = np.nonzero(_pairs_of(a, b, x == y))
    return _table(lang, a[u], b[v], whole[u, v])


def _dense(key: tuple, table: pa.Table) -> pa.Table:
    """The heavy terms' part of each pair of two tiles, over a block of terms."""
    lang, x, y, _ = (k.as_py() for k in key)
    g, p, empty = table.column("g").to_numpy(), table.column("p").combine_chunks(), table.column("empty").combine_chunks()
    marks = empty.is_valid().to_numpy(zero_copy_only=False)
    if marks.all():  # no term of this language lies in the block
        return _table(lang, *(np.zeros(0, np.int64),) * 3)
    groups = g[marks]
    order = np.argsort(groups)
    groups = groups[order]
    term = table.column("term").combine_chunks().filter(pa.array(~marks)).dictionary_encode()
    tile = np.repeat(empty.drop_null().to_numpy()[order][:, None], len(term.dictionary), axis=1)
    tile[np.searchsorted(groups, g[~marks]), term.indices.to_numpy()] = p.drop_null().to_numpy()
    a, b = _sides(groups, x, y)
    left, right = tile[np.searchsorted(groups, a)], tile[np.searchsorted(groups, b)]
    sums = np.stack([np.abs(right - row).sum(axis=1) for row in left]) if len(left) else np.zeros((0, len(right)), np.int64)
    u, v = np.nonzero(_pairs_of(a, b, x == y))
    return _table(lang, a[u], b[v], sums[u, v])


def ranked(rows: DataFrame) -> DataFrame:
    """`rows` with their rank in their group: the largest value first, then by item."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank."""
    told = Audit(docs, least_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    parts = [told.pairs().withColumn("part", F.lit("pair")), told.terms(top).withColumn("part", F.lit("term"))]
    return parts[0].select(columns).unionByName(parts[1].select(columns))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """The contract's rows over all documents."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""N-gram Jaccard join with rare-first prefix filtering, and the groups of linked documents.

A document's set holds its distinct word shingles (the whole sequence where it has fewer words, nothing
where it has none). Two documents link when their sets' Jaccard similarity is at least `percent` / 100.

1. Equal sets are one class: what follows is about classes, and a class of any size costs one row.
2. A count-min sketch over all shingles tells which occur once, and how frequent the others are. Every
   set is ordered rare first, by (rarity, hash), the same order everywhere. Sets that link share a shingle
   of their prefixes, the first n - ceil(n * percent / 100) + 1 places; shingles that occur once are shared
   with nobody and need not be sent.
3. Prefix shingles are joined, with the length filter, the positional filter (what can still be shared,
   given both places) and the suffix filter (of 256 hash ranges, those where one set has an odd and the
   other an even number of shingles: the sets differ in no fewer shingles). Each pair is verified once, on
   the shingles themselves, which are kept beside the prefixes.
4. A shingle that many classes share is not paired with itself: its classes first meet one hub, the class
   that has most shingles in common with others. Only classes that the links found so far leave in different groups
   are then paired with each other, under the same filters, so no link between groups is lost and a group
   of near copies costs as many pairs as it has members.
5. Groups are the connected components of the links, by label spreading with pointer jumping.

A text that shares much with many others and links with none (letters put together from stock sentences)
meets each of them under the filters: what the join looks at grows with the square of such a group, what
leaves it does not.

Null and empty texts have no set and are groups of their own. A null id takes part in links and gets the
group's smallest id; alone it is null. Repeated rows are one class. Very long texts are one set. Other
columns are not needed and may have any name. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import sketch, words
from .shared import bounded_batches, forget, join_many, saved, text_bytes

SHINGLE = 4
PERCENT = 85
#: Counters of at least so many are told apart by their size.
HEAVY = 16
#: Hash ranges of the suffix filter, 64 in a number.
RANGES = 256
PARITIES = RANGES // 64
WORD_BYTES = 6


_ADDRESS = pa.struct([("a", pa.int64()), ("b", pa.int64())])


class Shingler:
    """Sets of texts: sorted distinct shingle hashes."""

    def __init__(self, k: int, table: np.ndarray = words.SPACED, lower: bool = True):
        self.k, self.table, self.lower = k, table, lower

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        for first, last, data, offsets in words.slices(column):
            w = words.split(data, offsets, self.table, self.lower)
            grams = words.ngrams(w.hashes, self.k)
            for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
                if b - a >= self.k:
                    yield np.unique(grams[a : b - self.k + 1])
                else:
                    yield words.ngrams(w.hashes[a:b], b - a) if b > a else w.hashes[:0]


def _key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _keyed(shingler: Shingler, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys = [], []
            for shingles in shingler.sets(batch.column("text")):
                n.append(len(shingles))
                keys.append(_key(shingles))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("address"), pa.array(n, pa.int64()), pa.array(keys, pa.binary())], schema=schema)

    return run


def _once(shingler: Shingler, batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray]]:
    """The distinct sets of a batch."""
    seen = set()
    for shingles in shingler.sets(batch.column("text")):
        key = _key(shingles)
        if key is not None and key not in seen:
            seen.add(key)
            yield key, shingles


def _counted(shingler: Shingler):
    return lambda batch: (shingles for _, shingles in _once(shingler, batch))


def needed(n: int, percent: int) -> int:
    """The fewest shingles of a set of n that any set that links with it shares."""
    return -(-n * percent // 100)


def _parities(shingles: np.ndarray) -> np.ndarray:
    """One bit for each hash range: whether an odd number of the shingles lies in it."""
    counts = np.bincount((shingles >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64), minlength=RANGES)
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


def _prefixes(shingler: Shingler, estimates, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in _PREFIXES.names}
            for key, shingles in _once(shingler, batch):
                rarity = estimates.value.rarity(shingles)
                n, own = len(shingles), int((rarity == 0).sum())
                prefix = n - needed(n, percent) + 1
                if own >= prefix:
                    continue
                shared = shingles[rarity > 0]
                order = np.lexsort((shared, rarity[rarity > 0]))
                out["key"].append(key)
                out["n"].append(n)
                out["own"].append(own)
                out["parities"].append(_parities(shared))
                out["tokens"].append(shared[order[: prefix - own]].view(np.int64))
                out["shingles"].append(shared.view(np.int64))
            yield pa.RecordBatch.from_pydict(out, schema=_PREFIXES)

    return run


_PREFIXES = pa.schema([("key", pa.binary()), ("n", pa.int32()), ("own", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("parities", "tokens", "shingles"))])
_PREFIXES_SQL = "key binary, n int, own int, parities array<long>, tokens array<long>, shingles array<long>"


def linked(shared: F.Column, n: F.Column, m: F.Column, percent: int) -> F.Column:
    return shared * 100 >= (n + m - shared) * percent


def _may_link(a: str, b: str, percent: int) -> F.Column:
    """Length, positional and suffix filter on two postings of one shingle."""
    c = lambda side, name: F.col(f"{side}.{name}")
    n, m = c(a, "n"), c(b, "n")
    length = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    positional = linked(F.least(c(a, "before"), c(b, "before")) + 1 + F.least(n - c(a, "i") - 1, m - c(b, "i") - 1), n, m, percent)
    odd = sum((F.bit_count(c(a, f"r{r}").bitwiseXOR(c(b, f"r{r}"))) for r in range(PARITIES)), c(a, "own") + c(b, "own"))
    suffix = odd * (100 + percent) <= (n + m) * (100 - percent)
    # the first shingle that two sets share stands where enough of both is still to come: one such place will do
    first = linked(n - c(a, "i"), n, m, percent) & linked(m - c(b, "i"), n, m, percent)
    return length & first & positional & suffix


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node) of every node that has a link."""
    both = saved(links.select(F.col(a).alias("a"), F.col(b).alias("b")).union(links.select(b, a)).distinct(), "links")
    labels = saved(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("least"))
        spread = saved(labels.join(near, labels.node == near.a).select("node", F.col("component").alias("was"), F.least("component", "least").alias("component")), "labels")
        forget(labels)
        # where a component's own node has got to; a component may hold a third of all nodes
        next_ = spread.groupBy("component").agg(F.count(F.lit(1)).alias("n")).join(spread.select(F.col("node").alias("component"), F.col("component").alias("next")), "component")
        next_ = saved(next_, "labels")
        labels = saved(join_many(spread, next_, "component").select("node", F.col("next").alias("component"), (F.col("next") < F.col("was")).alias("moved")), "labels")
        forget(spread, next_)
        if labels.filter("moved").isEmpty():
            forget(both)
            return labels.select("node", "component")
        labels = labels.select("node", "component")


class Join:
    """The join over one table: the classes of its sets and the links between them."""

    def __init__(self, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT):
        self.spark, self.percent, self.shingler = docs.sparkSession, percent, Shingler(shingle)
        bounded_batches(self.spark)
        self.docs = docs.select("doc_id", address(F.col("doc_id"), F.col("text").cast("string")).alias("address"), F.col("text").cast("string").alias("text"))
        self.texts = self.docs.select("text")
        id_type = self.docs.schema["doc_id"].dataType
        schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("address", _ADDRESS), ("n_shingles", pa.int64()), ("key", pa.binary())])
        #: doc_id, address, n_shingles and key (of the class) of every row
        self.rows = saved(self.docs.mapInArrow(_keyed(self.shingler, schema), f"doc_id {id_type.simpleString()}, address struct<a: long, b: long>, n_shingles long, key binary"), "sets")

    def _postings(self) -> DataFrame:
        bits = sketch.bits_for(text_bytes(self.texts) / WORD_BYTES, 1, load=3)
        filled = self.texts.mapInArrow(sketch.filler(_counted(self.shingler), 1, bits), sketch.EMITTED)
        estimates = self.spark.sparkContext.broadcast(sketch.gather(filled, 1, bits, HEAVY))
        prefixes = self.texts.mapInArrow(_prefixes(self.shingler, estimates, self.percent), _PREFIXES_SQL)
        once = prefixes.groupBy("key").agg(*(F.first(c).alias(c) for c in _PREFIXES.names[1:]))
        #: one row for each class that can link with another, numbered; its shingles without those that occur once
        self.classes = saved(once.withColumn("node", F.monotonically_increasing_id()), "prefixes")
        parities = (F.get("parities", F.lit(r)).alias(f"r{r}") for r in range(PARITIES))
        sent = self.classes.select("node", "n", "own", *parities, F.posexplode("tokens").alias("p", "token"))
        shared = saved(sent.groupBy("token").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1"), "shared")
        # The sketch takes some shingles for shared that are not. Of what stands before a shared shingle, only what
        # another prefix holds too can be shared with it: in any other set, too, it would stand before.
        node = Window.partitionBy("node")
        before = F.row_number().over(node.orderBy("p")) - 1
        # classes with which a set shares a place of its prefix, on average: the centre of a group has most
        common = F.sum("classes").over(node) / (F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1)
        met = sent.join(shared, "token").withColumns({"before": before, "common": common, "i": F.col("own") + F.col("p")})
        postings = saved(met.drop("p", "classes"), "postings")
        forget(shared)
        return postings

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link. Both sets are brought together once."""
        pairs = saved(pairs, "pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = saved(self.classes.select("node", "n", "shingles").join(nodes, "node", "left_semi"), "shingles")
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"), F.col("n").alias("n"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"), F.col("n").alias("m"))
        shared = F.size(F.array_intersect("s", "t"))
        found = saved(pairs.join(left, "a").join(right, "b").filter(linked(shared, F.col("n"), F.col("m"), self.percent)).select("a", "b"), "found")
        forget(pairs, sets)
        return found

    def links(self) -> DataFrame:
        """a, b (nodes of classes) of links whose connected components are those of all links."""
        postings = self._postings()
        columns = [c for c in postings.columns if c != "token"]
        # the class that has most in common with the others is the hub of its shingles
        order = F.struct((-F.col("common")).alias("rank"), F.xxhash64("node").alias("draw"), *map(F.col, columns))
        hubs = saved(postings.groupBy("token").agg(F.min(order).alias("hub")).select("token", "hub.*"), "hubs")
        joined = postings.alias("x").join(hubs.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.node") != F.col("y.node")) & _may_link("x", "y", self.percent))
        pair = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
        first = saved(joined.select(*pair).distinct(), "hub-pairs")
        links = self._verified(first)
        groups = components(links)
        # shingles whose classes are not all in one group by now
        held = saved(postings.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")), "grouped")
        forget(postings, hubs)
        apart = held.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most").select("token")
        held = saved(held.join(apart, "token", "left_semi"), "apart")
        other = held.alias("x").join(
            held.alias("y"),
            (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & _may_link("x", "y", self.percent),
        )
        self.rest = saved(other.select(*pair).distinct(), "rest")
        return links.unionByName(self._verified(self.rest.join(first, ["a", "b"], "left_anti")))

    def firsts(self, first: F.Column) -> DataFrame:
        """key, n (rows) and the least `first` of its group for every class of sets."""
        found = components(self.links())
        keyed = self.classes.select("key", "node").join(found, "node").select("key", "component")
        classes = self.rows.filter("key is not null").groupBy("key").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
        classes = saved(classes.join(keyed, "key", "left"), "groups")
        merged = classes.filter("component is not null").groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n"))
        linked_ = join_many(classes.filter("component is not null").withColumnRenamed("n", "rows"), saved(merged, "groups"), "component")
        linked_ = linked_.select("key", F.col("rows").alias("n"), F.col("least").alias("first"))
        return saved(classes.filter("component is null").select("key", "n", "first").unionByName(linked_), "groups")

    def groups(self) -> DataFrame:
        """doc_id, n_shingles and component_id of every row."""
        rows = self.rows.select("doc_id", "n_shingles", "key")
        found = join_many(rows.filter("key is not null"), self.firsts(F.col("doc_id")), "key").select("doc_id", "n_shingles", F.col("first").alias("component_id"))
        return found.unionByName(rows.filter("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))

    def kept(self) -> DataFrame:
        """address and rows of the text that stays of each group: of the smallest id, nulls last, then address."""
        order = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "address")
        chosen = self.firsts(order).select(F.col("first.address").alias("address")).distinct()
        times = self.rows.filter("key is not null").groupBy("address").agg(F.count(F.lit(1)).alias("n"))
        return saved(times.join(chosen, "address", "left_semi"), "kept")


def address(doc_id: F.Column, text: F.Column) -> F.Column:
    """What rows equal in id and text have in common: 128 bits, hashed without a copy of the text."""
    name = doc_id.cast("string")
    return F.struct(F.xxhash64(name, text).alias("a"), F.xxhash64(F.lit(1), name, text).alias("b"))


def group_similar(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row of `docs`."""
    return Join(docs, shingle, percent).groups()


def drop_similar(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group, that with the smallest id, nulls last, with its own columns of any name; of rows
    that are equal in id and text one stays. Rows without words belong to no group and stay."""
    kept = Join(docs, shingle, percent).kept()
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    packed = docs.select(own.alias("doc"), address(F.col("doc_id"), F.col("text").cast("string")).alias("address"))
    words_ = F.coalesce(F.col("doc.text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # addresses to keep grow with the input: they are shuffled at every size
    out = packed.filter(words_).join(kept.hint("merge"), "address")
    if not kept.filter("n > 1").isEmpty():
        out = out.filter("n = 1").unionByName(out.filter("n > 1").groupBy("address").agg(F.first("doc").alias("doc"), F.first("n").alias("n")).select(*out.columns))
    return out.select("doc").union(packed.filter(~words_).select("doc")).select("doc.*")


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of documents."""
    return group_similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Spelling variants: words one edit apart, found in a positional q-gram index with a count filter.

Two words that differ by one inserted, deleted or replaced character share all but q of the longer word's
q-grams, each at the same position or one beside it. They meet at the rarest gram that they share: it is among
the first q + 1 of both in the order of rarity, and all before it are changed by the edit, so they lie within
q places. Each word is posted under the grams that this leaves, with their place and length, as the shorter or
the longer one of a pair. A gram that more than `hot` words hold is posted together with the second rarest that
they share (they share at least two), and a posting list that is still long is cut into chunks of which each
two meet in a task of their own. A task merges, for each word of a list, the postings of the word's other grams
at the places that they may have, with a heap, keeps the words that come up at least as often as the bound asks,
and verifies those.

The order of rarity is the only thing that is broadcast: the alphabet has 90 letters, hence at most 729,000
grams, whatever the corpus. Counts are summed in tasks with bounded memory before they are sent. A chain of
forms is at most as long as the decimal logarithm of the largest count; it is followed by doubling.

Null and empty texts have no words. A null id is an empty one. Repeated rows count as often as they stand
there; texts are read whole, words of any length; an empty table gives no words. Of near words with equal
counts the smallest is the form. Other columns are not needed and may have any name.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain, combinations, groupby
from operator import ne

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, forget, saved

Q = 3
LEAST_LENGTH = 7
LEAST_TIMES = 2
#: A form occurs at least so many times as often as its variant.
FORM_RATIO = 10
#: One run in so many loses a character, as the contract has it.
LOSES = 31
#: Grams of more words than this are posted with a second gram; longer posting lists than CHUNK are cut.
HOT = 4000
CHUNK = 8192
FLUSH_ENTRIES = 300_000
FLUSH_BYTES = 64 << 20

#: Runs that are long enough, whole ones: a search begins at a run's first letter. A-Z are small letters by then.
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: The same for texts of ASCII alone: what is no letter becomes a space.
_ASCII = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A else 32 for b in range(256))


def runs(raw: bytes) -> list[bytes]:
    """The distinct long runs of a text, A-Z as small letters, each as often as it occurs."""
    if raw.isascii():
        return [x for x in raw.translate(_ASCII).split() if len(x) >= LEAST_LENGTH]
    return [x.encode() for x in _RUN.findall(raw.translate(_LOWER).decode())]


def without(run: bytes, h: int) -> bytes:
    """A run without the character that its checksum h names."""
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}
    seen = 0

    def sent() -> Iterator[pa.RecordBatch]:
        items = list(held.items())
        for a in range(0, len(items), 50_000):
            word, n = zip(*items[a : a + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            raw = text.as_py()
            seed = zlib.crc32(f"{doc_id}:".encode())
            for run, n in Counter(runs(raw)).items():
                h = zlib.crc32(run, seed)
                if h % LOSES == 0:
                    run = without(run, h)
                held[run] = held.get(run, 0) + n
            seen += len(raw)
            if len(held) > FLUSH_ENTRIES or seen > FLUSH_BYTES:
                yield from sent()
                held.clear()
                seen = 0
    yield from sent()


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of the words of `docs` (doc_id, text) that are long and frequent enough."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counted = docs.select(text("doc_id").alias("id"), text("text").alias("text")).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter((F.col("n") >= LEAST_TIMES) & (F.length("word") >= LEAST_LENGTH))


def grams(word: str) -> list[str]:
    return [word[i : i + Q] for i in range(len(word) - Q + 1)]


def bound(longer: int) -> int:
    """How many grams words one edit apart share, the longer one of so many characters."""
    return longer - 2 * Q + 1


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            held.update(set(grams(word)))
    items = sorted(held.items())
    yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in items], pa.string()), pa.array([n for _, n in items], pa.int64())], names=["gram", "n"])


#: Where a word is posted: gram, its place, a second gram or '', and the length of the shorter word of a pair.
Key = tuple[str, int, str, int]


def _one_edit_apart(places: list[int]) -> bool:
    """Whether a single edit can change the grams at these places."""
    return not places or max(places) - min(places) < Q


def keys(word: str, held: dict[str, int], hot: int) -> list[Key]:
    """What a word is posted under: rare grams alone, frequent ones with one that is no rarer; at its own length, and as
    the longer word of a pair at one less, where a gram may stand one place further.

    Two near words meet at the rarest gram that they share. All rarer ones are changed by the edit, so they lie
    close together: beyond the first place where they do not, no gram can be the rarest that is shared."""
    order = sorted((held[g], g, p) for p, g in enumerate(grams(word)))
    placed = set()
    for j, (n, g, p) in enumerate(order):
        before = [x[2] for x in order[:j]]
        if n <= hot and _one_edit_apart(before):
            placed.add((g, p, ""))
        placed |= {(f, at, g) for i, (m, f, at) in enumerate(order[:j]) if m > hot and _one_edit_apart(before[:i]) and _one_edit_apart(before[:i] + before[i + 1 :])}
        if j > Q + 1:
            break
    n = len(word)
    out = {(g, p, h, n) for g, p, h in placed}
    if n > LEAST_LENGTH:
        out |= {(g, p - d, h, n - 1) for g, p, h in placed for d in (0, 1) if p >= d}
    return sorted(out)


def _post(broadcast, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*key, word, n) for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True) for key in keys(word, broadcast.value, hot)]
            for a in range(0, len(rows), 50_000):
                g, p, h, length, word, n = zip(*rows[a : a + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(p, pa.int32()), pa.array(h), pa.array(length, pa.int32()), pa.array(word), pa.array(n, pa.int64())], names=["g", "p", "h", "length", "word", "n"])

    return run


def one_edit(x: str, y: str) -> bool:
    """Whether y, as long as x or one longer, is exactly one edit away."""
    if len(x) == len(y):
        return sum(map(ne, x, y)) == 1
    for i, (a, b) in enumerate(zip(x, y, strict=False)):
        if a != b:
            return x[i:] == y[i + 1 :]
    return True


def near(words: list[str], key: Key) -> Iterator[tuple[int, int]]:
    """Pairs of places in `words`, each posted under `key`: of which one has the key's length, the other the same or
    one more.

    A gram before the edit stands at the same place in both words; behind it, at the same place where they are
    equally long, and one further where the other is longer."""
    g, at, h, length = key
    short = [k for k, word in enumerate(words) if len(word) == length]
    if not short or len(words) < 2:
        return
    ends = range(Q, length + 1)
    longer: dict[tuple[int, str], list[int]] = {}
    if len(short) < len(words):
        for k, word in enumerate(words):
            if len(word) > length:
                for e in range(Q, length + 2):
                    longer.setdefault((e, word[e - Q : e]), []).append(k)
    same: dict[tuple[int, str], list[int]] = {}
    for k in short:
        word = words[k]
        places = [(e, word[e - Q : e]) for e in ends]
        others = [x for x in places if x[1] != h and (x[1] != g or x[0] != at + Q)]  # all the words of the list have the rest
        least = bound(length) - (len(places) - len(others))
        if least < 1:
            others, least = places, bound(length)
        if same:
            lists = [same[x] for x in others if x in same]
            if len(lists) >= least:
                for y in often(lists, least):
                    if one_edit(word, words[y]):
                        yield k, y
        if longer:
            lists = [longer[x] for x in others if x in longer]
            lists += [longer[x] for x in [(e + 1, x) for e, x in others] if x in longer]
            if len(lists) > least:
                for y in often(lists, least + 1):
                    if one_edit(word, words[y]):
                        yield k, y
        for x in places:
            if x in same:
                same[x].append(k)
            else:
                same[x] = [k]


def often(lists: list[list[int]], least: int) -> list[int]:
    """What stands in at least so many of the sorted lists. It stands in one of all but the least - 1 longest at
    least: those are merged with a heap, and what they give is looked up in the longest."""
    lists.sort(key=len)
    few = len(lists) - least + 1
    long, out = lists[few:], []
    merged = heapq.merge(*lists[:few]) if few > 1 else lists[0]
    last, times = -1, 0
    for x in chain(merged, (-1,)):
        if x == last:
            times += 1
            continue
        if last >= 0:
            for y in long:
                if times >= least:
                    break
                place = bisect_left(y, last)
                if place < len(y) and y[place] == last:
                    times += 1
            if times >= least:
                out.append(last)
        last, times = x, 1
    return out


_PAIRS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string()), ("other_n", pa.int64())])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of the posting lists that a partition holds, one list after the other."""
    columns = ("g", "p", "h", "length", "x", "y", "chunk", "word", "n")
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    out: list[tuple] = []

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out, strict=True), _PAIRS, strict=True)], schema=_PAIRS)

    for (*key, x, y), own in groupby(rows, key=lambda r: r[:6]):
        listed = [r[6:] for r in own]
        for a, b in near([r[1] for r in listed], tuple(key)):
            (i, u, n), (j, v, m) = listed[a], listed[b]
            if x == y or i != j:
                out += [(u, n, v, m), (v, m, u, n)]
        if len(out) > 50_000:
            yield sent()
            out = []
    if out:
        yield sent()


def near_words(words: DataFrame, hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """word, n, other, other_n: every two of `words` (word, n; each word once) that are one edit apart, both ways."""
    spark = words.sparkSession
    rarity = spark.sparkContext.broadcast(_rarity(words))
    posted = saved(words.mapInArrow(_post(rarity, hot), "g string, p int, h string, length int, word string, n long"), "postings")
    key = ["g", "p", "h", "length"]
    long = posted.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > chunk).select(*key, F.ceil(F.col("_rows") / chunk).cast("int").alias("chunks"))
    cut = posted.join(long, key, "left").fillna(1, ["chunks"]).withColumn("chunk", F.pmod(F.xxhash64("word"), "chunks").cast("int"))
    cut = cut.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cut = cut.select(*key, F.least("chunk", "_with").cast("int").alias("x"), F.greatest("chunk", "_with").cast("int").alias("y"), "chunk", "word", "n")
    lists = cut.repartition(*key, "x", "y").sortWithinPartitions(*key, "x", "y")
    return lists.mapInArrow(_meet, "word string, n long, other string, other_n long").distinct()


def _rarity(words: DataFrame) -> dict[str, int]:
    """In how many words each gram stands; at most 90 ** Q grams."""
    counts = words.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(counts.column("gram").to_pylist(), counts.column("n").to_pylist(), strict=True))


def forms(words: DataFrame, pairs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, n, n_near, form and form_n of every word: its form is the most frequent near word, where that is frequent enough."""
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    about = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    return words.join(about, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
    )


def roots(told: DataFrame) -> DataFrame:
    """word and root of the words that have a form: forms are followed by doubling, a step for each power of two."""
    links = saved(told.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        went = saved(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        forget(links)
        links = went.select("word", "root")
        if went.filter("moved").isEmpty():
            return links


def variants(docs: DataFrame, hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of `docs` (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    words = saved(word_counts(docs), "words")
    told = saved(forms(words, near_words(words, hot, chunk)), "forms")
    forget(words)
    return told.join(roots(told), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every word of documents."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))

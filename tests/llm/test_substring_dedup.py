import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from dispatchlake.llm.substring_dedup import remove_repeats


def brute(rows, k):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for p in range(len(w) - k + 1):
            if seen[tuple(w[p : p + k])] > 1:
                gone |= set(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    vocab = ["a", "b", "zé", "Ünd", "x1", "the", " odd", "of"]
    passage = [rng.choice(vocab) + str(rng.randrange(50)) for _ in range(50)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one two"), (None, "lost id"), (4, "same word " * 60), (5, "x" * 300_000)]
    for i in range(10, n):
        w = [rng.choice(vocab) + str(rng.randrange(300)) for _ in range(rng.randrange(1, 200))]
        if rng.random() < 0.4:
            at = rng.randrange(len(w))
            w[at:at] = passage[rng.randrange(20) :]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    return [*rows, rows[15], (99, rows[16][1]), rows[3]]


def test_equals_brute_force(spark):
    for k in (35, 5):
        rows = texts(k)
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit(1), "n_words": F.lit("x"), "key": F.lit(None)})
        got = sorted(map(tuple, remove_repeats(docs.repartition(3), window=k).collect()), key=str)
        assert got == brute(rows, k)


def test_empty_table_and_other_names(spark):
    docs = spark.createDataFrame([], "name string, body string")
    assert remove_repeats(docs, "name", "body").collect() == []
    docs = spark.createDataFrame([("p", "x y " * 40)], "name string, body string")
    assert remove_repeats(docs, "name", "body", texts=False).first()[:3] == ("p", 80, 80)


def test_rows_without_an_id_spread_over_blocks(spark):
    rng = random.Random(2)
    rows = [(None, " ".join(f"w{rng.randrange(60):02d}" for _ in range(40))) for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, remove_repeats(docs.repartition(3), window=3).collect()), key=str)
    assert got == brute(rows, 3)
    blocks = docs.groupBy(F.pmod(F.xxhash64("doc_id", "text"), F.lit(16)).alias("block")).count().collect()
    assert len(blocks) == 16 and max(r["count"] for r in blocks) < 60

"""The audit of sources against the sums written out term by term."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dispatchlake.llm import divergence


def brute(rows, least, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, times, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        docs.update((lang, t) for t in set(terms))
        times[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for (k, t), n in docs.items() if k == lang and n >= least}
        sources = sorted(s for k, s in groups if k == lang)

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(times[lang, s]) for s in sources}
        q = shares(sum((times[lang, s] for s in sources), Counter()))
        for s in sources:
            parts = {
                "pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s],
                "term": [(t, p[s][t] - q[t]) for t in kept if times[lang, s][t] and p[s][t] > q[t]],
            }
            for part, values in parts.items():
                values.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(values) if part == "pair" or i < top]
    return sorted(out)


def told(spark, rows, least, top=50):
    docs = spark.createDataFrame([(1, *r) for r in rows], "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({"n": F.lit("x"), "term": F.lit(1), "value": F.lit(None), "i": F.lit(2)}).repartition(3)
    return sorted(map(tuple, divergence.audit(docs, least, top).collect()))


ODD = [(None, "en", "a"), ("", None, None), ("Éa éa ÉA x9y", "", "a"), (" \n", "fr", None), ("only here", "xx", "y"), ("the The THE-the", None, "a")]


@pytest.mark.parametrize(("sources", "least", "top"), [(3, 2, 4), (70, 3, 50), (150, 2, 3)])
def test_equals_the_sums(spark, sources, least, top):
    rng = random.Random(sources)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "éstuvwxyz"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [*ODD, ("long " * 20_000 + "\U0001f642 end", "en", "s0")]
    for _ in range(sources * 3):
        lang = rng.choice(["en", "en", "de"])
        rows.append((" ".join(rng.choices(words, weights, k=rng.randint(0, 12))), lang, f"s{rng.randrange(sources)}"))
    rows += rows[:5]
    assert told(spark, rows, least, top) == brute(rows, least, top)


def test_a_group_that_shares_nothing(spark):
    rows = [("a b", "l", "x"), ("a c", "l", "y"), ("", "l", "z"), ("q", "m", "x"), ("q", "m", "y")]
    assert told(spark, rows, 1) == brute(rows, 1)
    assert {r[4] for r in told(spark, rows, 9)} == {0}


def test_empty_table(spark):
    assert told(spark, [], 1) == []

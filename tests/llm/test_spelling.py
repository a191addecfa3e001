"""Spelling variants against every word compared with every other."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dispatchlake.llm import spelling


def distance_is_one(x, y):
    """By all strings that one edit of the longer one can give."""
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: m for w, m in n.items() if m >= 2 and len(w) >= 7}
    near = {w: [o for o in n if distance_is_one(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def told(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(1), "id": F.lit(None)}).repartition(3)
    return sorted(map(tuple, spelling.variants(docs, **more).collect()))


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abé", k=rng.randint(6, 11))) for _ in range(60)] + ["".join(rng.choices("abcdefÀÿz", k=rng.randint(7, 14))) for _ in range(60)] + ["aaaaaaaa", "aaaaaaa", "aaaaaaaaa"]
    for w in words[::2]:
        for _ in range(4):
            at, c = rng.randrange(len(w)), rng.choice("abcé")
            words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]]))
    rows = [(None, None), (0, ""), (1, " \n"), (None, "Straße STRASSE Ünlike ünlike ×××××××× ××××××××"), (2, "y" * 3000 + " " + "y" * 3000 + " " + "y" * 2999 + " " + "y" * 2999)]
    for i in range(150):
        rows.append((i % 140, " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(words, [1 / (k + 1) ** 1.5 for k in range(len(words))], k=80))))
    return rows + rows[-3:]


@pytest.mark.parametrize(("hot", "chunk"), [(spelling.HOT, spelling.CHUNK), (0, spelling.CHUNK), (5, 3), (0, 2)])
def test_equals_all_pairs(spark, hot, chunk):
    rows = corpus(hot + chunk)
    want = brute(rows)
    assert any(w[1] for w in want)
    assert told(spark, rows, hot=hot, chunk=chunk) == want


def test_a_chain_of_forms_is_followed_to_its_end(spark):
    words = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij"]
    rows = [(k, f"{w} " * (2 * 12**i)) for i, w in enumerate(words) for k in [next(k for k in range(100, 200) if zlib.crc32(f"{k}:{w}".encode()) % 31)]]
    out = {r[0]: r for r in told(spark, rows)}
    assert out == {r[0]: r for r in brute(rows)}
    assert out["abcdefg"][2] == "abcdefghij"


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=7, max_size=9), st.text("ab", min_size=7, max_size=9))
def test_one_edit(x, y):
    x, y = sorted((x, y), key=len)
    if len(y) - len(x) < 2:
        assert spelling.one_edit(x, y) == distance_is_one(x, y)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=7, max_size=10), unique=True, max_size=25), st.sampled_from([0, 3, 100]))
def test_near_words_meet_under_a_key(words, hot):
    held = Counter(g for w in words for g in set(spelling.grams(w)))
    lists = {}
    for w in words:
        for key in spelling.keys(w, held, hot):
            lists.setdefault(key, []).append(w)
    found = {frozenset((own[a], own[b])) for key, own in lists.items() for a, b in spelling.near(own, key)}
    assert found == {frozenset((x, y)) for x in words for y in words if distance_is_one(x, y)}


def test_empty_table(spark):
    assert told(spark, []) == []

"""Packing against the algorithm written for single documents, and every id against the library."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dispatchlake.llm import packing

PATH = packing.tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["Hello, world! it's 2024", "<|endoftext|>x<|endoftext|> y", "É café  naïve", "don't  stop\n\n\tnow", "日本語 テキスト", "a" * 9000, "nbsp em  \u0085x 　", "word " * 3000, "<|endoftext", "\x00\x1c x"]
ROWS = [(0, None), (1, ""), (2, " \n"), (None, "no id"), *((10 + i, t) for i, t in enumerate(TEXTS)), (10, TEXTS[0]), (10, "other text")]


def plain(lengths, capacity):
    """One document after the other."""
    left, bins = sorted(lengths), []
    while left:
        held, room = [], capacity
        while fits := [x for x in left if x <= room]:
            held.append(max(fits))
            left.remove(held[-1])
            room -= held[-1]
        if room and len(held) > 1:
            s = min(held)
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[:i] if s < a + b <= room + s]
            if pairs:
                _, a, b = max(pairs)
                held.remove(s)
                left.remove(a)
                left.remove(b)
                left = sorted([*left, s])
                held += [a, b]
        bins.append(tuple(sorted(held, reverse=True)))
    return Counter(bins)


def opened(patterns):
    out = Counter()
    for held, bins in patterns:
        out[tuple(length for length, n in held for _ in range(n))] += bins
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(3, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=70))))
def test_patterns_are_those_of_single_documents(case):
    capacity, lengths = case
    assert opened(packing.best_two_fit(Counter(lengths), capacity)) == plain(lengths, capacity)


def test_a_large_histogram_has_few_patterns_and_little_waste():
    rng = random.Random(5)
    histogram = Counter(min(1024, int(rng.lognormvariate(5.5, 1.1)) + 1) for _ in range(300_000))
    patterns = packing.best_two_fit({k: n * 1000 for k, n in histogram.items()}, 1024)
    least = -(-sum(k * n for k, n in histogram.items()) * 1000 // 1024)
    assert sum(p.bins for p in patterns) <= 1.001 * least and len(patterns) < 8192


def test_places_are_gapless():
    patterns = packing.best_two_fit({5: 7, 3: 11, 2: 1, 1: 4}, 10)
    places, seen = packing.Places(patterns), {}
    for length, n in {5: 7, 3: 11, 2: 1, 1: 4}.items():
        for s, o in zip(*places.find(np.full(n, length), np.arange(n)), strict=True):
            seen.setdefault(int(s), []).append((int(o), length))
    assert len(seen) == places.sequences
    for held in seen.values():
        assert all(o == sum(x for _, x in sorted(held)[:i]) for i, (o, _) in enumerate(sorted(held))) and sum(x for _, x in held) <= 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "Z", "'", "s", " ", "\n", "\t", " ", "　", "\u0085", "\x1c", "é", "1", "²", "-", "<|endoftext|>", "🙂", "日", "́"]), max_size=14).map("".join))
def test_ids_are_the_library_s(text):
    encode = packing.encoder(PATH)
    assert encode.fast is not None
    assert encode.ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_another_tokenizer_is_left_to_the_library():
    path = packing.tokenizer_path("word_bpe_49k.json")
    assert packing.Encoder(path).fast is None
    assert packing.Encoder(path).ids("Some words") == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [1, 7, 1024])
def test_every_piece(spark, capacity):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"length": F.lit("x"), "part": F.lit(1), "number": F.lit(None)}).repartition(3)
    out = packing.pack(packing.pieces(docs, PATH, capacity), capacity).collect()
    library, want = LIBRARY, []
    for i, text in ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        for k, at in enumerate([0, *range(first, len(ids), capacity)]):
            own = ids[at : first if k == 0 else at + capacity]
            want.append((i, k, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out], key=str) == sorted(want, key=str)
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    assert Counter(tuple(sorted((x for _, x in held), reverse=True)) for held in bins.values()) == plain([w[3] for w in want], capacity)


def test_sequences_hold_their_documents(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    library, told = LIBRARY, Counter()
    for i, text in ROWS:
        told[i] += len(library.encode(text or "", add_special_tokens=False).ids) + 1
    held = Counter()
    for r in packing.sequences(docs, PATH, 64).collect():
        assert len(r.ids) == sum(r.lengths) <= 64
        for i, n in zip(r.doc_ids, r.lengths, strict=True):
            held[i] += n
    assert held == told


def test_empty_table_and_other_id_types(spark):
    assert packing.pack(packing.pieces(spark.createDataFrame([], "doc_id string, text string"), PATH)).collect() == []
    with pytest.raises(ValueError):
        packing.pieces(spark.createDataFrame([("a", "b")], "doc_id string, text string"), PATH, 0)

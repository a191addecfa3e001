"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns whose names clash."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dispatchlake.llm import decontaminate, license_scan, mixing, neighbours, sharding, similar_sets, toxicity, words

CLASH = {"n_words": "x", "key": None, "spans": 3, "score": "s", "slot": 9, "shard": "z", "hash": 1, "blob": "b"}


def clash(df):
    return df.withColumns({name: F.lit(value).cast("int" if isinstance(value, int) else "string") for name, value in CLASH.items()})


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def base_rows(extra):
    return [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (None, "no id here"), (4, "x" * 200_000), (5, "word " * 5000), *extra]


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- op4 -------------------------------------------------------------------------------------------


def test_sharding_table_is_filled_in_turns():
    names, m = ("a", "b", "c", "d", "e"), 101
    order = {s: [(sharding._number(s, "offset") + j * (sharding._number(s, "step") % (m - 1) + 1)) % m for j in range(m)] for s in names}
    table, at = {}, dict.fromkeys(names, 0)
    for s in itertools.cycle(names):
        if len(table) == m:
            break
        while order[s][at[s]] in table:
            at[s] += 1
        table[order[s][at[s]]] = names.index(s)
    assert sharding.fill(names, m) == [table[i] for i in range(m)]
    counts = np.bincount(sharding.fill(), minlength=64)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill(names[:-1], m)
    kept = [i for i, s in enumerate(sharding.fill(names, m)) if s != 4]
    assert sum(fewer[i] == sharding.fill(names, m)[i] for i in kept) > 0.7 * len(kept)
    for bad in ((names, 100), ((), 101), (("a", "a"), 101)):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


def test_sharding(spark):
    rows = base_rows([(3, "again")])
    out = sharding.place(clash(frame(spark, rows)))
    assert out.columns == ["doc_id", "text", *[c for c in CLASH if c not in ("slot", "shard")], "slot", "shard"]
    table = sharding.fill()
    for r in out.collect():
        slot = int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, table[slot])
    assert out.count() == len(rows) and sharding.place(frame(spark, [])).count() == 0


# --- op5 -------------------------------------------------------------------------------------------


def brute_groups(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    find = lambda i: i if group[i] == i else find(group[i])
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            group[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def near_copies(seed):
    rng = random.Random(seed)
    rows = []
    for n, length in ((40, 60), (30, 150), (10, 12)):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for _ in range(n):
            w = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3, 5))):
                w[rng.randrange(len(w))] = f"e{rng.randrange(100_000)}"
            rows.append((len(rows) + 100, " ".join(w).title() if rng.random() < 0.2 else " ".join(w)))
    return rows + [(900 + i, "A Common line of words " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))) for i in range(30)]


def test_similar_groups(spark):
    rows = base_rows(near_copies(1) + [(98, "one"), (97, "a b"), (96, "a b")])
    docs = clash(frame(spark, rows))
    got = collected(similar_sets.group_similar(docs))
    assert got == brute_groups(rows, 4, 85)
    kept = similar_sets.drop_similar(docs)
    assert kept.columns == docs.columns
    firsts = {c for d, n, c in got if d is not None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(firsts)


def test_drop_similar_decides_by_row(spark):
    """Copies without an id, an id with several texts, rows equal in all."""
    line, other = "one line of seven words here now", "quite another line of some words too"
    rows = [(None, line), (None, line), (None, other), (None, other), (5, other), (5, line + " and more of it"), (6, line + " and more of it"), (7, "x y"), (7, "x y"), (None, "solo"), (8, None), (8, None), (9, "  ")]
    docs = frame(spark, rows).withColumns({"address": F.lit("here"), "doc": F.lit(1), "n": F.lit("n")})
    out = similar_sets.drop_similar(docs)
    assert out.columns == docs.columns and {(r["address"], r["doc"], r["n"]) for r in out.collect()} == {("here", 1, "n")}
    want = [(None, line), (5, other), (5, line + " and more of it"), (7, "x y"), (None, "solo"), (8, None), (8, None), (9, "  ")]
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect()) == sorted((str(i), str(t)) for i, t in want)
    assert similar_sets.drop_similar(docs.limit(0)).count() == 0


def test_letters_of_stock_sentences_do_not_pair_all_with_all(spark):
    """Six of sixty sentences each: much is shared, little links, and few pairs leave the filters."""
    rng = random.Random(21)
    stock = [" ".join(f"s{i}w{j}" for j in range(12)) for i in range(60)]
    rows = [(i, " ".join(rng.sample(stock, 6))) for i in range(1200)] + [(5000, "x")]
    rows += [(6000 + i, rows[i][1] + " end") for i in range(20)]
    join = similar_sets.Join(frame(spark, rows))
    got = collected(join.groups())
    assert got == brute_groups(rows, 4, 85)
    assert join.rest.count() < 200


@pytest.mark.parametrize("seed", [11, 12])
def test_similar_groups_of_overlapping_sets(spark, seed):
    """Single words, so that sets share much and prefixes hold what others hold behind theirs."""
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = rng.sample(range(70), rng.randrange(15, 45))
        for _ in range(14):
            w = [x for x in base if rng.random() > 0.05] + rng.sample(range(70, 90), rng.randrange(0, 3))
            rng.shuffle(w)
            rows.append((len(rows), " ".join(f"w{x}" for x in w)))
    assert collected(similar_sets.group_similar(frame(spark, rows), shingle=1)) == brute_groups(rows, 1, 85)


def test_similar_groups_of_nothing(spark):
    assert similar_sets.group_similar(frame(spark, [])).count() == 0
    same = frame(spark, [(7, "a b c d e"), (7, "a b c d e"), (5, "a b c d e")])
    assert {tuple(r) for r in similar_sets.group_similar(same).collect()} == {(7, 2, 5), (5, 2, 5)}
    assert [r["doc_id"] for r in similar_sets.drop_similar(same).collect()] == [5]


# --- op6 -------------------------------------------------------------------------------------------

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs far away from here now"), (2, "short item"), (3, None), (4, "..."), (5, "The quick brown fox jumps over the lazy dog and runs far away"), (None, "short item"), (6, "solo")]


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, bench=ITEMS):
    w, hit, items = alnum(text), set(), set()
    for item, t in bench:
        b = alnum(t)
        k = min(13, len(b))
        for x in {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if k else ():
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) == x:
                    hit |= set(range(p, p + k))
                    items |= {str(item)} - {"None"}
    return w, hit, items


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_BYTES, 60])
def test_decontamination(spark, most):
    texts = ["THE quick-brown fox: jumps over the lazy dog and runs far away from here now! " + "pad " * 10, "short item short item", "a short, item", "solo", "pad " * 100 + "solo", "the quick brown fox jumps over the lazy dog"]
    rows = base_rows([(20 + i, t) for i, t in enumerate(texts)] + [(20, texts[0])])
    docs, bench = clash(frame(spark, rows)), spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {(r["n_words"], r["spans"]) for r in kept.collect()} == {("x", 3)}
    want = []
    for i, t in rows:
        w, hit, items = brute_hits(t)
        want.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    assert collected(decontaminate.report(docs, bench)) == sorted(want, key=str)
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == sorted(str(x[0]) for x in want if not x[5])
    cut = {r["doc_id"]: r["text"] for r in decontaminate.cut_spans(docs, bench).collect()}
    assert cut[22] == "a " and cut[23] == "" and cut[3] == "one"
    several = decontaminate.find_hits(docs, bench, most=most).select("doc_id", decontaminate.hit_words().alias("n"), F.size("items").alias("m"))
    assert collected(several) == sorted(((x[0], x[2], x[3]) for x in want), key=str)


def test_benchmark_windows_are_bounded_arrays():
    import pyarrow as pa

    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(1000)}" for _ in range(rng.randrange(1, 400))) for _ in range(3000)]
    texts += ["a " * 50_000, "b"]
    windows = decontaminate.Windows(pa.table({"item_id": [str(i) for i in range(len(texts))], "text": texts}), 13)
    size = sum(len(t.encode()) for t in texts)
    assert windows.size() <= 11 * size and windows.size() < 6 * size
    w = words.split(np.frombuffer(texts[7].encode(), np.uint8), np.array([0, len(texts[7])]), words.ALNUM, lower=True)
    found = {x for _, _, items in windows.hits(w) for x in items}
    assert "7" in found


def test_hits_add_up_over_parts_of_the_benchmark(spark):
    rng = random.Random(10)
    items = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice((1, 2, 3, 20))))) for i in range(80)]
    items += [(200, items[0][1]), (None, items[1][1]), items[2]]
    docs = clash(frame(spark, base_rows([(300 + i, " ".join(f"w{rng.randrange(40)}" for _ in range(60)) + " " + items[i][1]) for i in range(40)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    digest = lambda most: collected(decontaminate.find_hits(docs, bench, most=most).select("doc_id", "n_words", decontaminate.hit_words().alias("n"), "items"))
    whole, parts = digest(1 << 24), digest(400)
    assert len(decontaminate.parts_of(bench, 400)) > 4 and whole == parts and sum(len(r[3]) for r in whole) > 100


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_BYTES, 9000])
def test_many_equal_items_meet_many_occurrences(spark, most):
    items = [(i, "yes" if i % 3 else "No, thanks") for i in range(2000)] + [(None, "yes"), (7, "other yes item"), (7, "yes"), (9, "no thanks")]
    rows = base_rows([(20 + i, t) for i, t in enumerate(["yes " * 3000, "no YES thanks", "No thanks" * 500, "yes, no thanks; other yes item", "nothing here"])] + [(40 + i, "yes") for i in range(500)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        windows.setdefault(tuple(re.findall("[a-z]+", t.lower())), set()).add(i)
    want = []
    for i, t in rows:
        w = re.findall("[a-z0-9]+", (t or "").lower())
        hit, found = set(), set()
        for x, ids in windows.items():
            at = [a for a in range(len(w)) if tuple(w[a : a + len(x)]) == x]
            hit |= {a + j for a in at for j in range(len(x))}
            found |= ids if at else set()
        ids = sorted(str(x) for x in found if x is not None)
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    assert collected(decontaminate.report(frame(spark, rows), bench, most=most)) == sorted(want, key=str)


def test_an_occurrence_costs_the_same_whatever_the_items():
    import time

    import pyarrow as pa

    class Sent:
        value = decontaminate.Windows(pa.table({"item_id": [str(i) for i in range(4000)], "text": ["yes"] * 4000}), 13)

    began = time.perf_counter()
    for texts in (["yes " * 4000], ["yes"] * 4000):
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
        assert {n for out in decontaminate._report(Sent)(iter([batch])) for n in out.column("n_items").to_pylist()} == {4000}
    assert time.perf_counter() - began < 0.5


def test_decontamination_without_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert collected(decontaminate.report(frame(spark, [(1, "a b")]), none)) == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert decontaminate.report(frame(spark, []), none).count() == 0


# --- op9 -------------------------------------------------------------------------------------------


def brute_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = left / max(1, sum(weight[s] for s in order if s not in full))
        target = {s: 3 * sizes[s] if s in full else share * weight[s] for s in order}
        over = {s for s in order if s not in full and target[s] >= 3 * sizes[s]}
        if not over or not total:
            return target
        full |= over


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice(["a", "b", "c", "c", "c", None, "é"])) for i in range(900)]
    rows += [(2000 + i, "tiny", "zz") for i in range(3)] + [(3000, None, "b"), (3001, "", "empty"), (None, "lost one", "b"), rows[5]]
    rows += [(3002, "long " * 100_000, "long")]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    got = mixing.mix(clash(docs)).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect())) and len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target, source, taken = brute_targets(sizes), {i: s for i, _, s in rows}, {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= (50_000 if s == "long" else 60), (s, taken[s], target[s])
    out = mixing.apply_mix(clash(docs))
    assert out.columns == clash(docs).columns and {r["hash"] for r in out.collect()} == {1}
    assert out.agg(F.sum(mixing.size_of(F.col("text")))).first()[0] == sum(taken.values())
    assert mixing.mix(frame(spark, [], "doc_id long, text string, source string")).count() == 0


@pytest.mark.parametrize("row", [lambda i: (None, f"w{i} and one"), lambda i: (7, f"w{i} and one"), lambda i: (None, "same three words"), lambda i: (i, "same three words")])
def test_mixing_of_ties_comes_within_a_row_of_each_target(spark, row):
    """Rows without an id, of one id, and rows that are equal: neither all taken nor all left."""
    rows = [(*row(i), "a" if i % 2 else "b") for i in range(1000)]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == 1000 and {r["source_size"] for r in got} == {1500}
    for target in (1000, 2000):
        assert abs(sum(r["taken"] for r in got if abs(r["target"] - target) < 1e-9) - target) <= 3
    assert collected(mixing.mix(docs.repartition(5))) == sorted(map(tuple, got), key=str)
    assert abs(mixing.apply_mix(docs).count() - 1000) <= 2


def test_apply_mix_keeps_columns_of_any_name(spark):
    names = ("_source", "_passes", "_threshold", "_times", "_pass", "of", "passes", "threshold", "times", "key", "number", "part", "row", "doc", "size", "hash", "source_size")
    rows = [(i % 40, f"w{i % 40} x", "a" if i % 4 else None) for i in range(200)]
    docs = frame(spark, rows, "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in names})
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns and {tuple(r[c] for c in names) for r in out.collect()} == {names}
    assert mixing.apply_mix(docs.limit(0)).count() == 0


def test_targets_of_many_sources(spark):
    rng = random.Random(7)
    sizes = {f"s{i}é" if i % 2 else f"S{i}": rng.choice((1, 5, 40, 900, 0)) for i in range(60)} | {None: 30}
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(7))
    want = brute_targets(sizes)
    assert {r["source"]: round(r["target"], 6) for r in found.collect()} == {s: round(t, 6) for s, t in want.items()}


# --- op10 ------------------------------------------------------------------------------------------


def brute_license(text):
    """labels and score: for each diagonal, the template's places at the first of the next diagonals, in order."""
    w, labels, score = alnum(text), set(), 0.0
    for label, phrase in license_scan.BASE:
        b = phrase.split()
        if any(w[p : p + len(b)] == b for p in range(len(w))):
            labels, score = labels | {label}, 1.0
    for label, t in license_scan.TEXTS:
        b, k = alnum(t), license_scan.GRAM
        votes = [(p - q, q) for q in range(len(b) - k + 1) for p in range(len(w) - k + 1) if w[p] == b[q] and w[p : p + k] == b[q : q + k]]
        for anchor, _ in votes:
            first = {}
            for d, q in sorted(votes, reverse=True):
                if anchor <= d <= anchor + license_scan.DRIFT:
                    first[q] = q + d
            n, end = 0, -1
            for q in sorted(first):
                n, end = n + (first[q] > end), max(end, first[q])
            share = n / (len(b) - k + 1)
            score = max(score, share)
            if share >= license_scan.COVERED:
                labels.add(label)
    return ",".join(sorted(labels)), score


def test_license_scan(spark):
    rng = random.Random(6)
    mit, isc, bsd = (max((t for label, t in license_scan.TEXTS if label == x), key=len) for x in ("mit", "isc", "bsd"))
    notice = min((t for label, t in license_scan.TEXTS if label == "mit"), key=len)
    cut = notice.split(" ")
    swapped = bsd.split(" ")
    for i in range(0, len(swapped) - 12, 12):
        swapped[i : i + 12] = rng.sample(swapped[i : i + 12], 12)
    halves = mit.split(" ")
    halves = halves[len(halves) // 2 :] + halves[: len(halves) // 2]
    texts = ["MIT License. mit-license!", "the Apache  LICENSE and GNU General Public License", "general public mit license mit", "Permission: " + notice.upper(), " ".join(cut[:9] + ["really"] + cut[9:]), " ".join(cut[:6]), "É mit licensee"]
    texts += ["permission to use " * 8, "free software " * 16, "the terms of " * 12, "this software " * 12, mit + " " + isc, "x " * 50 + mit.replace("copies of", "copies (all of them) of"), " ".join(swapped), "MİT LICENSE mit licenſe", " ".join(halves), mit * 3]
    for t in (mit, isc, bsd):
        w = t.split(" ")
        for _ in range(3):
            copy = [x for x in w if rng.random() > 0.1]
            copy[rng.randrange(len(copy)) : 0] = ["put", "in"] * rng.randrange(8)
            texts.append(" ".join(copy))
    rows = base_rows([(20 + i, t) for i, t in enumerate(texts)] + [(21, texts[1])])
    got = {}
    for r in license_scan.scan(clash(frame(spark, rows))).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, t in rows:
        w = alnum(t)
        places = [(p, label) for label, phrase in license_scan.BASE for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        r = got[i][0]
        starts = [p for p, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(places), min(starts, default=None), max(starts, default=None)), t
        assert r["base_labels"] == ",".join(sorted({x for _, x in places})) and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert (r["labels"], r["score"]) == brute_license(t), t
        assert {s["label"] for s in r["spans"]} == set(r["labels"].split(",")) - {""} and all(0 <= s["start"] < s["end"] <= len(w) for s in r["spans"])
    label = lambda i: got[20 + i][0]["labels"]
    assert label(3) == "mit" and got[23][0]["score"] == 1 and label(4) == "mit" and label(5) == ""
    # repeated phrases of a license and the words of one in another order are no license
    assert [label(i) for i in (7, 8, 9, 10, 13)] == [""] * 5 and label(11) == "isc,mit" and label(12) == "mit"
    assert min(s["start"] for s in got[32][0]["spans"]) == 50
    assert license_scan.scan(frame(spark, [])).count() == 0


# --- op2 -------------------------------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1200):
        w = [rng.choice(vocab) for _ in range(rng.randrange(20, 80))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["moron", "Idiot", "scum"])
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    rows += [(5000, None), (5001, ""), (None, "w1 w2"), (5002, "idiot " * 20_000), rows[7]]
    labels += [(9999, 1), (8, None), (None, 1), (7, labels[7][1])]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    assert 0 < len(model[0]) < 5000
    scored = toxicity.score(clash(docs), model)
    assert scored.columns[-1] == "score" and scored.count() == len(rows)
    truth, right = dict(labels[:1200]), []
    for r in scored.collect():
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
            right.append((r["score"] >= 0.5) == bool(truth[r["doc_id"]]))
    assert sum(right) / len(right) > 0.95
    flags = {r[0]: r[1] for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id"))).collect()}
    assert all(flags[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(1200))
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["score"] < 0.5 for r in toxicity.score(docs, toxicity.train(docs, empty)).limit(20).collect())
    assert toxicity.score(frame(spark, []), model).count() == 0


def brute_ftrl(rows):
    """FTRL-proximal one coordinate after the other, in the operator's order of rows."""
    t = toxicity
    z, n = {}, {}

    def weight(c):
        if c == -1:  # the intercept has no L1 penalty
            return -z.get(c, 0.0) / ((t.BETA + n.get(c, 0.0) ** 0.5) / t.ALPHA + t.L2)
        if abs(z.get(c, 0.0)) <= t.L1:
            return 0.0
        return -(z[c] - np.sign(z[c]) * t.L1) / ((t.BETA + n[c] ** 0.5) / t.ALPHA + t.L2)

    for epoch in range(t.EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            _, label, coordinates = rows[i]
            each = [-1, *coordinates]
            w = {c: weight(c) for c in each}
            p = 1 / (1 + np.exp(-sum(w.values())))
            g = (p - label) * (t.TOXIC_COST if label else 1)
            for c in each:
                sigma = ((n.get(c, 0.0) + g * g) ** 0.5 - n.get(c, 0.0) ** 0.5) / t.ALPHA
                z[c] = z.get(c, 0.0) + g - sigma * w[c]
                n[c] = n.get(c, 0.0) + g * g
    return {c: weight(c) for c in z}


def test_ftrl_steps(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "L1", 1.0)
    rng = random.Random(9)
    rows = [(i, int(i % 4 == 0), sorted(rng.sample(range(40), 6) + ([50] if i % 4 == 0 else [51]))) for i in range(60)]
    table = pa.table({"key": [r[0] for r in rows], "toxic": [r[1] for r in rows], "features": [np.array(r[2], "<u4").tobytes() for r in rows]})
    got = toxicity._fitted((0,), table)
    got = dict(zip(got.column("coordinate").to_pylist(), got.column("weight").to_pylist(), strict=True))
    want = {c: w for c, w in brute_ftrl(rows).items() if w or c == -1}
    assert set(got) == set(want) and len(want) < 43 and all(abs(got[c] - want[c]) < 1e-4 for c in want)


def test_features_are_words_pairs_and_skip_pairs():
    data = np.frombuffer(b"A b, c! a b c", np.uint8)
    found = [(c.tolist(), t.tolist()) for c, t in toxicity.features(toxicity._words(data, np.array([0, 7, len(data)])))]
    assert [[t.count(i) for _, t in found] for i in (0, 1)] == [[3, 2, 1]] * 2
    assert all(c[: len(c) // 2] == c[len(c) // 2 :] for c, _ in found) and len({x for c, _ in found for x in c}) == 6


def test_toxicity_teaches_a_bounded_number_of_rows(spark):
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5][:3]
    docs = spark.range(30_000).select(F.element_at(F.array(*map(F.lit, ids)), (F.col("id") % 3 + 1).cast("int")).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int")
    assert 0 < toxicity.drawn(docs, labels, 10).count() <= 10
    assert toxicity.drawn(docs.withColumn("text", F.lit("one")), labels, 10).count() == 3


def test_toxicity_draws_alike_whatever_the_types_of_ids(spark):
    docs = frame(spark, [(i, f"text {i} {'w ' * (i % 50)}") for i in range(3000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    drawn = lambda d, m, **more: collected(toxicity.drawn(d, m, 500, **more).select("key", "toxic"))
    want = drawn(docs, labels)
    assert 350 < len(want) <= 500
    for a, b in (("int", "long"), ("string", "long"), ("long", "string"), ("int", "string")):
        assert drawn(docs.withColumn("doc_id", F.col("doc_id").cast(a)), labels.withColumn("doc_id", F.col("doc_id").cast(b))) == want


def test_toxicity_bounds_the_bytes_that_teach(spark, monkeypatch):
    docs = frame(spark, [(i, "word " * 200 + str(i)) for i in range(2000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 200_000)
    assert 100 < toxicity.drawn(docs, labels).count() < 400


def test_drop_toxic(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["idiot", "scum"]) if i % 3 == 0 and rng.random() < 0.4 else f"w{rng.randrange(50)}" for _ in range(30))) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    docs = clash(frame(spark, [*rows, (None, "w1 w2"), (700, None), (701, ""), rows[1]])).withColumns({"toxicity": F.lit("t"), "_toxicity": F.lit(5)})
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert {(r["toxicity"], r["_toxicity"], r["score"]) for r in got} == {("t", 5, "s")}
    ids = [r["doc_id"] for r in got]
    assert {None, 700, 701} <= set(ids) and ids.count(1) == 2 and sum(i % 3 == 0 for i in ids if i is not None and i < 600) < 20 and len(ids) > 380
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0


# --- op8 -------------------------------------------------------------------------------------------


def brute_nearest(ids, v, k=5):
    """(query_id, row) -> the true scores, nearest first, over every row but the query's own."""
    x = np.asarray(v, np.float64)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    out = {}
    for q in [i for i, d in enumerate(ids) if d % 50 == 0]:
        scores = (x * x[q]).sum(1)
        order = sorted((i for i in range(len(ids)) if i != q), key=lambda i: (-round(scores[i], 12), ids[i]))[:k]
        out.setdefault(ids[q], []).append([(ids[i], scores[i]) for i in order])
    return out


@pytest.mark.parametrize("block, sample", [(4096, 1 << 17), (200, 1 << 17), (40, 64)])
def test_neighbours(spark, monkeypatch, block, sample):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "SAMPLE", sample)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 48))
    v = (centres[rng.integers(0, 12, 1500)] + 0.4 * rng.standard_normal((1500, 48))).astype(np.float32)
    v[300:700] = v[300]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    bad = [(2000, None), (2050, [0.0] * 48), (2100, [float("nan")] + [1.0] * 47), (2150, [1.0, None] + [1.0] * 46), (2200, [1.0] * 3), (None, [1.0] * 48)]
    df = clash(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(4))
    search = neighbours.Search(df, F.col("vec_id") % 50 == 0)
    got = {}
    for r in search.result.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want, hits = brute_nearest(range(1500), v), 0
    assert set(got) == set(range(0, 1500, 50))
    for q, found in got.items():
        found.sort()
        (truth,) = want[q]
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and all(s <= t + 1e-9 for (_, _, s), (_, t) in zip(found, truth, strict=True))
        assert [(s, i) for _, i, s in found] == sorted(((s, i) for _, i, s in found), key=lambda x: (-round(x[0], 12), x[1]))
        hits += len({i for i, _ in truth} & {i for _, i, _ in found})
    told = search.found.agg(F.sum("verified"), F.count_distinct("of")).first()
    share, recall = told[0] / (told[1] * len(np.unique(v, axis=0))), hits / 150
    print(f"recall {recall:.3f}, verified {share:.3f} of all points")
    assert recall >= 0.9 and share < 0.35
    assert [i for _, i, _ in got[300]] == [301, 302, 303, 304, 305] and [i for _, i, _ in got[650]] == [300, 301, 302, 303, 304]


def test_neighbours_of_each_length(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for length, ids in ((8, range(0, 160)), (5, range(200, 260)), (3, range(300, 302))):
        v = rng.standard_normal((len(ids), length))
        rows += [(i, x.tolist()) for i, x in zip(ids, v, strict=True)]
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        for a, i in enumerate(ids):
            if i % 50 == 0:
                order = sorted((b for b in range(len(ids)) if b != a), key=lambda b: (-(unit[a] @ unit[b]), ids[b]))[:5]
                want[i] = [ids[b] for b in order]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, confidence=0.9999).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert {q: [r[k] for k in sorted(r)] for q, r in got.items()} == want and len(want[300]) == 1


def test_neighbours_with_repeated_ids_and_few_rows(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((40, 8)).astype(np.float32)
    ids = [50, 50, 50, *range(100, 137)]
    v[1], v[2] = -v[0], v[0]  # two rows of the query's id, one of them equal to it
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest(df.repartition(3), F.col("vec_id") % 50 == 0, confidence=0.9999).collect():
        got.setdefault((r["query_id"], r["rank"]), []).append((r["vec_id"], round(r["score"], 9)))
    want = {}
    for q, of in brute_nearest(ids, v).items():
        for found in of:
            for rank, (i, s) in enumerate(found, 1):
                want.setdefault((q, rank), []).append((i, round(s, 9)))
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}
    few = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert collected(neighbours.nearest(few, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id")) == [(0, 1, 3), (0, 2, 50), (50, 1, 3), (50, 2, 0)]
    assert neighbours.nearest(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert neighbours.nearest(few.filter("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0
    none = spark.createDataFrame([(0, [0.0, 0.0]), (50, None)], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none, F.col("vec_id") % 50 == 0).count() == 0


def test_chi_square_quantile():
    assert abs(neighbours.quantile(0.95, 8) - 15.507313) < 1e-5 and abs(neighbours.quantile(0.5, 2) - 1.386294) < 1e-5


# --- words -----------------------------------------------------------------------------------------


def test_words_and_hashes():
    import pyarrow as pa

    texts = ["a  bé\tc", None, "", " x\ny", "z" * 600_000 + " end", "a", "\x0b\x0c"]
    for table, pattern in ((words.SPACED, r"[^\x20\x09-\x0D]+"), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        for column in (pa.array(texts), pa.array(texts).slice(2, 4), pa.chunked_array([texts[:3], texts[3:]]), pa.array(texts, pa.large_string())):
            found, seen = [], {}
            for a, b, data, offsets in words.slices(column, 50):
                w = words.split(data, offsets, table)
                for i in range(b - a):
                    found.append([w.word(j).decode() for j in range(w.offsets[i], w.offsets[i + 1])])
                    for j in range(w.offsets[i], w.offsets[i + 1]):
                        assert seen.setdefault(w.word(j), w.hashes[j]) == w.hashes[j]
            assert found == [re.findall(pattern, t.as_py() or "") for t in column]
            assert len(set(seen.values())) == len(seen)
